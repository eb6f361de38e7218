"""Quality rules as weak supervision.

Rules vote good or bad on a document or abstain.  Documents with the same votes
are counted together (3^rules patterns at most, whatever the corpus), and
expectation-maximisation over these counts estimates each rule's accuracy on
good and on bad documents and the share of good ones.  A document is kept by
its posterior probability, not by passing every rule.  Documents that the two
base limits reject need no verdict, so the estimate is made on the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneldeck.llm.text import stripped, whole, words
from paneldeck.session import write_stage

# How often a rule is expected to be right on good and on bad documents: a rule
# seldom votes against a good one, and passes most bad ones of another kind.
EXPECTED = (0.95, 0.4)

# name: (vote good if, vote bad if) over the counts below
RULES = {
    "symbols": ("n_symbols <= 0.02 * n_words", "n_symbols > 0.1 * n_words"),
    "symbol_runs": ("n_symbol_runs <= 0.01 * n_words", "n_symbol_runs > 0.1 * n_words"),
    "repeats": ("n_repeat_words <= 0.15 * n_words", "n_repeat_words > 0.3 * n_words"),
    "lines": ("n_lines > 1 and n_dup_lines <= 0.05 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    "word_length": ("word_chars between 3 * n_words and 8 * n_words",
                    "word_chars < 2 * n_words or word_chars > 12 * n_words"),
    "capitals": ("n_upper <= 0.15 * n_letters", "n_upper > 0.4 * n_letters"),
    "letters": ("n_letters >= 0.93 * word_chars", "n_letters < 0.9 * word_chars"),
    "variety": ("n_distinct >= 0.4 * n_words", "n_distinct < 0.15 * n_words"),
    "stops": ("n_stops between 0.02 * n_words and 0.25 * n_words", "n_stops < 0.002 * n_words"),
}


def count_features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and the counts that the rules read, from the whole text."""
    base = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    split = base.select("id", "text", words(F.col("text")).alias("w"),
                        F.filter(F.split("text", "\n", -1), lambda l: stripped(l) != "").alias("lines"))
    n = F.size("w")
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))))
    hashed = split.select("id", "text", "w", "lines",
                          F.coalesce(windows, F.array().cast("array<bigint>")).alias("h"))
    # positions of windows found twice: sorted by hash, those equal to a neighbour
    pairs = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    sorted_ = hashed.select("id", "text", "w", "lines", F.when(
        F.size(F.array_distinct("h")) < F.size("h"), pairs).alias("s"))
    shift = lambda a, k: F.slice(a, F.lit(1 + k), F.greatest(F.size(a) - 1, F.lit(0)))
    near = F.flatten(F.zip_with(shift(F.col("s"), 0), shift(F.col("s"), 1), lambda a, b: F.when(
        a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))
    at = sorted_.select("id", "text", "w", "lines", F.sort_array(F.array_distinct(near)).alias("at"))
    # each such window covers its three words, up to where the next one starts
    covered = F.aggregate(
        F.zip_with(shift(F.col("at"), 0), shift(F.col("at"), 1), lambda a, b: F.least(F.lit(3), b - a)),
        F.lit(3), lambda s, x: s + x)
    plain = F.array_join("w", "")
    text = F.col("text")
    without = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    return at.select(
        "id", F.size("w").cast("long").alias("n_words"), F.length(plain).cast("long").alias("word_chars"),
        without("[#*$%&|<>]+").cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[#*$%&|<>]+")).cast("long").alias("n_symbol_runs"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("at") > 0, covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        without(r"\p{L}+").cast("long").alias("n_letters"),
        without(r"\p{Lu}+").cast("long").alias("n_upper"),
        without(r"[.!?]+").cast("long").alias("n_stops"))


def votes(rules: dict[str, tuple[str, str]]) -> list[Column]:
    """1 good, -1 bad, 0 abstains; a document without words abstains throughout."""
    return [F.when(F.col("n_words") == 0, 0).when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)
            .alias(f"v_{name}") for name, (good, bad) in rules.items()]


def posterior(names: list[str], prior: float, right: dict[str, tuple[float, float]]) -> Column:
    """Probability that a document is good given its votes.  ``right``: how often
    a rule that votes is right on good and on bad documents."""
    from math import log

    odds = F.lit(log(prior / (1 - prior)))
    for name in names:
        good, bad = right[name]
        odds = odds + (F.when(F.col(f"v_{name}") == 1, log(good / (1 - bad)))
                       .when(F.col(f"v_{name}") == -1, log((1 - good) / bad)).otherwise(0.0))
    return 1 / (1 + F.exp(-odds))


def fit_rules(patterns: DataFrame, names: list[str], rounds: int = 30,
              tolerance: float = 1e-4) -> tuple[float, dict[str, tuple[float, float]]]:
    """Expectation-maximisation over counted vote patterns (columns v_<name>, n).
    Each round is one aggregate; one row of sums reaches the driver."""
    prior, right = 0.7, {name: EXPECTED for name in names}
    for _ in range(rounds):
        good = F.col("n") * F.col("p")
        bad = F.col("n") * (1 - F.col("p"))
        sums = [F.sum(good).alias("good"), F.sum("n").alias("n")]
        for name in names:
            v = F.col(f"v_{name}")
            sums += [F.sum(F.when(v == 1, good).otherwise(0.0)).alias(f"{name}_gg"),
                     F.sum(F.when(v != 0, good).otherwise(0.0)).alias(f"{name}_g"),
                     F.sum(F.when(v == -1, bad).otherwise(0.0)).alias(f"{name}_bb"),
                     F.sum(F.when(v != 0, bad).otherwise(0.0)).alias(f"{name}_b")]
        row = patterns.withColumn("p", posterior(names, prior, right)).agg(*sums).first()
        if not row["n"]:
            break
        # Five pseudo-votes of the expected accuracy.  A rule is never taken for worse than
        # chance on good documents, nor likelier to vote bad on these than on bad
        # ones; how rarely it catches bad ones is left to the counts.
        new = {}
        for name in names:
            hit_good = min(0.999, max(0.5, (row[f"{name}_gg"] + 5 * EXPECTED[0]) / (row[f"{name}_g"] + 5)))
            hit_bad = min(0.999, max(1.001 - hit_good, (row[f"{name}_bb"] + 5 * EXPECTED[1]) / (row[f"{name}_b"] + 5)))
            new[name] = (hit_good, hit_bad)
        new_prior = min(0.99, max(0.01, (row["good"] + 1) / (row["n"] + 2)))
        moved = max([abs(new_prior - prior), *(abs(a - b) for k in names for a, b in zip(new[k], right[k]))])
        prior, right = new_prior, new
        if moved < tolerance:
            break
    return prior, right


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: dict[str, tuple[str, str]] = RULES, threshold: float = 0.5) -> DataFrame:
    """One row per document: id, the counts, votes v_<rule>, p_good, base_failed,
    kept.

    base_failed: under 50 words, or over half the words in repeated three-word
    windows.  kept: not base_failed and p_good of ``threshold`` or more.

    Null text has no words: every count 0, base_failed.  A document on which
    every rule abstains gets the estimated share of good ones.  Repeated rows and
    null ids: one result row for each row.  An empty table gives an empty result.
    Other columns are not read.  Windows of words are compared by 64-bit hash
    within one document.
    """
    counts = count_features(docs, id_col, text_col)
    voted = write_stage(counts.select("*", *votes(rules)), "quality-votes")
    names = list(rules)
    columns = [f"v_{name}" for name in names]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    patterns = write_stage(voted.where(~failed).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")),
                           "quality-patterns")
    prior, right = fit_rules(patterns, names)
    out = voted.withColumn("p_good", posterior(names, prior, right)).withColumn("base_failed", failed)
    return (out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
            .withColumnRenamed("id", id_col))
