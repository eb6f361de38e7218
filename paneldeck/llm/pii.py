"""Personal data: patterns propose, checksums confirm, context words adjust.

Each pattern yields, over the whole text, its leftmost non-overlapping matches
and the text between them (``regexp_extract_all`` and ``split`` on the same
pattern), so the start of a match is the running sum of what precedes it.
Matches become rows; the sums are windows over one document's matches of one
kind, validators and scores are column expressions, and only matches are ever
shuffled, never texts.

The patterns use possessive loops: the JVM runs those without recursion, and
no run of characters is scanned twice, so very long texts neither overflow the
stack nor take quadratic time.  ``EDGE`` lets a match start at the beginning of
a run or where the last match ended, which is where the leftmost match starts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneldeck.llm.text import whole
from paneldeck.session import write_stage

CONTEXT_CHARS = 40


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.  ``needs``: a cheap pattern that every text
    with a match contains.  ``base``: stays whatever its score."""

    name: str
    needs: str
    pattern: str
    base: bool
    prior: float
    confirmed: float
    words: str


KINDS = (
    Kind("email", "@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         True, 0.8, 0.0, "e-?mail|contact|write"),
    Kind("ip", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         True, 0.5, 0.2, "ip|address|host|server"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11}", r"[0-9](?:[\x20-]?[0-9])++",
         True, 0.3, 0.5, "card|visa|mastercard|credit|debit|amex"),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]",
         True, 0.6, 0.1, "phone|tel|call|mobile|fax"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         False, 0.3, 0.6, "iban|account|bank"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         False, 0.3, 0.2, "ssn|social security|tax id"),
)
AGAINST = r"version|isbn|token|invoice|order|serial|sample|example"
ACCEPT = 0.7


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    n = F.length(digits)
    digit = lambda i: F.substring(digits, n - i + 1, F.lit(1)).cast("int")
    term = lambda i: F.when(i % 2 == 1, digit(i)).otherwise(
        2 * digit(i) - F.when(digit(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + term(i)) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an international account number has the check digits it should."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    number = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda s, c: (s * F.when(c.between("0", "9"), 10).otherwise(100) + number(c)) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda s, c: F.when(c == "", s).otherwise(step(s, c))) == 1


def _small_parts(value: Column) -> Column:
    small = lambda p: F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.substring(F.ltrim(p, F.lit("0")), 1, 3))
    return F.forall(F.split(value, r"\."), lambda p: F.coalesce(
        F.when(small(p) == "", 0).otherwise(small(p).cast("int")) <= 255, F.lit(False)))


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "ip", _small_parts(value))
            .when(kind == "card", F.when(n.between(12, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(9, 15))
            .when(kind == "iban", mod97(value))
            .when(kind == "ssn", ~value.rlike("^(?:000|666|9)|-00-|-0000$"))
            .otherwise(True))


def _proposals(text: Column, no: int, kind: Kind) -> Column:
    """Array of (kind, no, gap, value, before, after) of one pattern; null
    without any."""
    gaps, found = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    near = F.transform(F.slice(gaps, F.lit(2), F.size(gaps)), lambda g: F.left(g, F.lit(CONTEXT_CHARS)))
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(gaps) - 1).alias("gap"), found.alias("value"),
                          near.alias("after"))
    made = F.transform(zipped, lambda z: F.struct(
        F.lit(no).alias("kind_no"), F.length(z["gap"]).alias("gap"), z["value"].alias("value"),
        F.right(z["gap"], F.lit(CONTEXT_CHARS)).alias("before"), z["after"].alias("after")))
    return F.when(text.rlike(kind.needs), made)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             accept: float = ACCEPT) -> DataFrame:
    """id, spans: array of (start, kind_no, kind, end, score, base, value) by
    start, then kind; code points, end exclusive.  One row per document.

    Base kinds that pass their validator stay at any score; the others need a
    score of ``accept`` or more: the kind's prior, plus what its validator adds,
    plus or minus 0.25 for context words within 40 code points (up to the
    neighbouring match of the kind) that speak for or against it.

    Null or empty text: no spans.  Repeated rows and null ids: one result row
    for each row.  An empty table gives an empty result.  Other columns are not
    read.
    """
    text = F.col("text")
    lists = [F.coalesce(_proposals(text, no, kind), F.array().cast(
        "array<struct<kind_no:int,gap:int,value:string,before:string,after:string>>"))
        for no, kind in enumerate(KINDS)]
    # the row numbers are written with the matches, so a rerun task cannot change them
    found = write_stage(
        docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
        .select("id", F.monotonically_increasing_id().alias("row"), *[x.alias(k.name) for x, k in zip(lists, KINDS)]),
        "pii-found")
    every = F.array(*[F.expr(f"transform({k.name}, (m, i) -> struct(m as m, i as i))") for k in KINDS])
    rows = (found.select("row", F.explode(F.flatten(every)).alias("x"))
            .select("row", "x.i", "x.m.*"))
    upto = (Window.partitionBy("row", "kind_no").orderBy("i")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    length = F.length("value")
    placed = rows.withColumn("end", F.sum(F.col("gap") + length).over(upto))
    pick = lambda attr: F.element_at(F.array(*[F.lit(getattr(k, attr)) for k in KINDS]), F.col("kind_no") + 1)
    named = placed.withColumn("kind", pick("name")).withColumn("base", pick("base"))
    valid = named.where(_valid(F.col("kind"), F.col("value")))
    near = F.lower(F.concat_ws(" ", "before", "after"))
    speaks = F.lit(False)
    for k in KINDS:
        speaks = speaks | ((F.col("kind") == k.name) & near.rlike(rf"\b(?:{k.words})\b"))
    score = (pick("prior") + pick("confirmed") + F.when(speaks, 0.25).otherwise(0.0)
             - F.when(near.rlike(rf"\b(?:{AGAINST})\b"), 0.25).otherwise(0.0))
    kept = valid.withColumn("score", F.round(score, 3)).where(F.col("base") | (F.col("score") >= accept))
    spans = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        (F.col("end") - length).cast("long").alias("start"), "kind_no", "kind",
        F.col("end").cast("long").alias("end"), "score", "base", "value"))).alias("spans"))
    kinds = "array<struct<start:bigint,kind_no:int,kind:string,end:bigint,score:double,base:boolean,value:string>>"
    return (found.select("row", "id").join(spans, "row", "left")
            .select(F.col("id").alias(id_col), F.coalesce(F.col("spans"), F.array().cast(kinds)).alias("spans")))


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
