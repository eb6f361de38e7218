"""Mixing sources to target weights.

Every source has a word budget.  Documents get hash-random keys; within a
source they are range-sorted by key into blocks of bounded size, block totals
give a distributed prefix sum of word counts, and the mix is cut at the exact
budget: whole epochs first, then documents in key order, the last one in part.
No task holds a whole source, however large it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneldeck.llm.text import fresh, whole, word_count
from paneldeck.session import write_stage

KEY_RANGE = 1 << 60


def random_key(id_col: str, seed: int) -> Column:
    """60 uniform bits from the id, the same on every run (null id: its own key)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: DataFrame, cap: float) -> DataFrame:
    """Budget of every source: shares of the grand total by weight, cut at
    ``cap`` times the source's size, the excess reshared by weight among the
    others until none is above.  ``sources``: source, source_size; ``weights``:
    source, weight.  Each pass is one aggregate over the sources; only two sums
    reach the driver."""
    table = write_stage(sources.join(weights, F.expr("source <=> w_source"), "left")
                        .select("source", "source_size",
                                F.coalesce("weight", F.lit(0.0)).alias("weight")), "mix-sources")
    limit = F.col("source_size") * F.lit(float(cap))
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    rate = 0.0
    while True:
        full = limit < F.col("weight") * F.lit(rate)
        got = table.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("cut"),
            F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not got["open"]:
            break
        new = (total - got["cut"] * float(cap)) / got["open"]
        if new <= rate:
            break
        rate = new
    return table.select("source", "source_size",
                        F.least(limit, F.col("weight") * F.lit(rate)).alias("target"))


def source_order(sources: DataFrame, pieces: int) -> DataFrame:
    """source, number: position of each source in code-point order from 0, null
    last.  Ranges of the names are numbered apart and offset by what precedes
    them, so the sources never meet in one task."""
    parts = write_stage(
        sources.select("source").repartitionByRange(pieces, F.col("source").asc_nulls_last())
        .withColumn("part", F.spark_partition_id()), "mix-order")
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # one row per range, `pieces` at most
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return (parts.withColumn("no", F.row_number().over(order) - 1).join(before, "part")
            .select("source", (F.col("no") + F.col("before")).alias("number")))


def cyclic_weights(sources: DataFrame, cycle: int = 3, pieces: int = 16) -> DataFrame:
    """w_source, weight: 1 to ``cycle`` in turn by the order of the names."""
    return source_order(sources, pieces).select(
        F.col("source").alias("w_source"),
        (F.col("number") % cycle + 1).cast("double").alias("weight"))


def mix_plan(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source", cap: float = 3.0, seed: int = 20,
             block_rows: int = 20_000) -> DataFrame:
    """One row per document: id, size, source, source_size, target, copy_no, taken.

    ``weights`` (w_source, weight; a source without a row gets 0) shares the
    total number of words; without it the weights cycle 1, 2, 3 by source name.
    ``taken`` is how many words of the document the mix takes, repeats counted:
    whole epochs, then documents in the order of their random keys until the
    source's budget, rounded to a whole word, is reached.

    Null text: 0 words.  A null source is a source of its own, ordered last.
    Ties of the key are ordered by id, then size; rows repeated with the same
    id, source and size share what they take evenly, by copy_no.  An empty table gives an empty result.  Other columns are not read.
    """
    rows = write_stage(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                    word_count(whole(text_col)).alias("size")), "mix-sizes")
    sources = write_stage(rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                     F.count(F.lit(1)).alias("n")), "mix-totals")
    if weights is None:
        weights = cyclic_weights(sources)
    targets = source_targets(sources.select("source", "source_size"), weights, cap)
    budgets = write_stage(
        targets.join(sources.select(F.col("source").alias("s"), "n"), F.expr("source <=> s")).select(
            "source", "source_size", "target",
            F.floor(F.col("n") / block_rows).cast("long").alias("last_block"),
            F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size")))
            .otherwise(0).cast("long").alias("epochs"))
        .withColumn("rest", F.round("target").cast("long") - F.col("epochs") * F.col("source_size")),
        "mix-budgets")

    # equal rows are one row with a count, so a window never meets ties
    grouped = rows.groupBy("source", "id", "size").agg(F.count(F.lit(1)).alias("copies"))
    block = F.floor(F.col("key") / (F.lit(KEY_RANGE) / (F.col("last_block") + 1))).cast("long")
    keyed = (grouped.withColumn("key", random_key("id", seed)).alias("d")
             .join(budgets.alias("b"), F.expr("d.source <=> b.source"))
             .select("d.id", "d.source", "size", "copies", "key", "source_size", "target", "epochs", "rest",
                     block.alias("block")))
    keyed = write_stage(keyed, "mix-keyed")
    in_block = (Window.partitionBy("source", "block").orderBy("key", F.col("id").asc_nulls_last(), "size")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    blocks = keyed.groupBy("source", "block").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    earlier = (Window.partitionBy("source").orderBy("block")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = blocks.select(F.col("source").alias("o_source"), F.col("block").alias("o_block"),
                            F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    mass = F.col("size") * F.col("copies")
    summed = (keyed.withColumn("upto", F.sum(mass).over(in_block))
              .join(write_stage(offsets, "mix-offsets"), F.expr("source <=> o_source and block = o_block")))
    start = F.col("before") + F.col("upto") - mass
    left = F.greatest(F.lit(0), F.least(mass, F.col("rest") - start))
    copy_no = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no")
    share = F.expr("left_words div copies + if(copy_no <= left_words % copies, 1, 0)")
    return (summed.withColumn("left_words", left).select("*", copy_no)
            .select("id", "size", "source", "source_size", "target", "copy_no",
                    (F.col("epochs") * F.col("size") + share).cast("long").alias("taken")))


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", **options) -> DataFrame:
    """``mix_plan`` with the documents' own id column."""
    out = mix_plan(docs, weights, id_col, **options)
    return out.select(F.col("id").alias(id_col), "size", "source", "source_size", "target", "taken")


def first_words(text: Column, n: Column) -> Column:
    """The text up to its n-th word."""
    return F.array_join(F.slice(F.split(text, "(?<=[^\\x20\\x09-\\x0D])(?=[\\x20\\x09-\\x0D])"), F.lit(1), n), "")


def mixed(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", **options) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: each document as often as
    it is taken whole, and its first words where the budget cuts it.  Documents
    without words, and those past their source's budget, are not in it."""
    names = fresh(docs, "_id", "_source", "_size", "_no", "_taken", "_words", "_copy", "_turn")
    p_id, p_source, p_size, p_no, p_taken, words, copy, turn = names
    plan = mix_plan(docs, weights, id_col, text_col, source_col, **options).where("taken > 0").select(
        F.col("id").alias(p_id), F.col("source").alias(p_source), F.col("size").alias(p_size),
        F.col("copy_no").alias(p_no), F.col("taken").cast("int").alias(p_taken))
    numbered = (docs.withColumn(words, word_count(whole(text_col)))
                .withColumn(copy, F.row_number().over(
                    Window.partitionBy(id_col, source_col, words).orderBy(F.xxhash64(text_col)))))
    taken = numbered.join(plan, F.col(id_col).cast("long").eqNullSafe(F.col(p_id))
                          & F.col(source_col).cast("string").eqNullSafe(F.col(p_source))
                          & (F.col(words) == F.col(p_size)) & (F.col(copy) == F.col(p_no)))
    turns = F.explode(F.sequence(F.lit(1), F.ceil(F.col(p_taken) / F.col(p_size)).cast("int"))).alias(turn)
    left = F.col(p_taken) - (F.col(turn) - 1) * F.col(p_size)
    cut = F.when(left >= F.col(p_size), F.col(text_col)).otherwise(first_words(F.col(text_col), left.cast("int")))
    return taken.select("*", turns).select(
        *[cut.alias(c) if c == text_col else F.col(c) for c in docs.columns])
