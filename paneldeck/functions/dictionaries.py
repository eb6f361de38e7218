"""Keyword dictionaries.  A dictionary is plain data: ``{category: regex}``.

Matching is case-insensitive with word boundaries, on lower-cased text.
"""

# ---------------------------------------------------------------------------
# The two food-category dictionaries of the studied pipeline,
# kept unchanged (including its known gaps such as plural "carrots", Q10).
# ---------------------------------------------------------------------------

# Long dialect (daily flags).
FOOD_KEYWORDS_LONG = {
    "potato": r"\b(potato|potatoes|russet|yukon|red potato|baked potato|mashed)\b",
    "beans": r"\b(beans?|black bean|pinto|navy|kidney|garbanzo|chickpea|lentils?)\b",
    "rice": r"\b(rice|brown rice|white rice|wild rice|jasmine|basmati)\b",
    "oats": r"\b(oats?|oatmeal|rolled oats|steel cut|porridge)\b",
    "bread": r"\b(bread|toast|bagel|roll|bun|loaf|wheat bread|white bread)\b",
    "fruit": r"\b(fruit|apple|banana|orange|berry|berries|grape|melon|peach|pear)\b",
    "vegetables": r"\b(vegetables?|veggie|carrot|broccoli|spinach|lettuce|tomato|pepper)\b",
    "dairy": r"\b(dairy|milk|cheese|yogurt|butter|cream|cottage cheese)\b",
    "meat": r"\b(meat|beef|chicken|pork|turkey|fish|salmon|tuna|steak|ham)\b",
    "egg": r"\b(eggs?|scrambled|boiled|fried|omelet|egg white)\b",
    "nuts": r"\b(nuts?|almond|walnut|peanut|cashew|pecan|pistachio|seed)\b",
}

# Wide dialect (weekly flags and mention counts).
FOOD_KEYWORDS_WIDE = {
    "potato": r"\b(potato|potatoes|baked potato|mashed|roasted potato|potato salad)\b",
    "beans": r"\b(beans|bean|chickpea|chickpeas|lentils|lentil|kidney bean|black bean)\b",
    "rice": r"\b(rice|brown rice|white rice|wild rice|jasmine rice|basmati)\b",
    "oats": r"\b(oats|oatmeal|steel cut|overnight oats|porridge)\b",
    "bread": r"\b(bread|toast|bagel|whole wheat|sourdough|baguette)\b",
    "fruit": r"\b(fruit|apple|banana|berries|berry|orange|grape|strawberry)\b",
    "vegetables": r"\b(vegetables|vegetable|carrot|broccoli|spinach|pepper|tomato)\b",
    "dairy": r"\b(dairy|milk|cheese|yogurt|yoghurt|cottage cheese|cream)\b",
    "meat": r"\b(meat|chicken|fish|salmon|beef|pork|turkey|lamb)\b",
    "egg": r"\b(eggs|egg|scrambled|omelet|omelette|hard boiled|fried egg)\b",
    "nuts": r"\b(nuts|nut|almond|walnut|cashew|peanut|pecan|hazelnut)\b",
}

# ---------------------------------------------------------------------------
# Dictionary over the driver tables' part names ("red plate", "small widget").
# Same shape as the food dictionaries: singular/plural alternatives and a few
# two-word phrases, all ASCII so Java and RE2 word boundaries agree.
# ---------------------------------------------------------------------------
PART_KEYWORDS = {
    "widget": r"\b(widgets?|small widget)\b",
    "gear": r"\b(gears?|gizmos?)\b",
    "ring": r"\b(rings?|blue ring)\b",
    "bolt": r"\b(bolts?|rods?)\b",
    "plate": r"\b(plates?|hot plate)\b",
    "anvil": r"\b(anvils?)\b",
    "warm": r"\b(hot|red)\b",
    "cool": r"\b(cold|blue)\b",
    "size": r"\b(small|large)\b",
    "age": r"\b(old|new)\b",
}

# Common-word dictionary for mention counts over English documents.
DOCUMENT_KEYWORDS = {
    "the": r"\b(the)\b",
    "and": r"\b(and)\b",
    "of": r"\b(of)\b",
    "with": r"\b(with|without)\b",
    "on": r"\b(on|onto)\b",
}
