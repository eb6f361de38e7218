"""Chat formatting after cumulative-snapshot collapse.

A log often holds the same conversation again after every turn.  Each step of a
conversation gets a 128-bit hash of its position and content; the rolling
exclusive-or of these is the hash of the prefix up to it.  A conversation is a
snapshot of a longer one if that one has the same prefix hash at its length, so
an anti-join of the ends with the distinct inner prefixes leaves the maximal
conversations, which are then rendered.

Exclusive-or composes: a conversation with very many steps is hashed in
stretches of turn numbers, each offset by what precedes it.  All of this runs on
hashes; texts are only read again for the conversations that are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneldeck.llm.text import whole
from paneldeck.session import write_stage

# The marks of the public ChatML layout.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _with_offsets(steps: DataFrame, name: str, totals: dict[str, Column], combine) -> DataFrame:
    """Add to every step, as before_<x>, the totals of the stretches before its own."""
    blocks = steps.groupBy("conv", "stretch").agg(*[total.alias(x) for x, total in totals.items()])
    earlier = (Window.partitionBy("conv").orderBy(F.col("stretch").asc_nulls_last())
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = blocks.select(F.col("conv").alias("o_conv"), F.col("stretch").alias("o_stretch"), *[
        F.coalesce(combine(F.col(x)).over(earlier), F.lit(0)).alias(f"before_{x}") for x in totals])
    return (steps.join(write_stage(offsets, name), F.expr("conv <=> o_conv and stretch <=> o_stretch"))
            .drop("o_conv", "o_stretch"))


def prefix_hashes(conversations: DataFrame, conv: str, turn: str, role: str, text: str,
                  stretch: int) -> DataFrame:
    """conv, no, p1, p2: the steps of each conversation from 1 and the hash of
    the conversation up to each.  Turns that share a number are one step."""
    row = F.struct(whole(F.col(role).cast("string")).alias("role"), whole(text).alias("text"))
    hashed = conversations.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.xxhash64(row).alias("h1"), F.xxhash64(F.lit("second"), row).alias("h2")).distinct()
    steps = write_stage(
        hashed.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h1").alias("h1"),
                                           F.bit_xor("h2").alias("h2"))
        .withColumn("stretch", F.floor(F.col("turn") / stretch)), "chat-steps")
    placed = _with_offsets(steps, "chat-places", {"n_steps": F.count(F.lit(1))}, F.sum)
    inside = Window.partitionBy("conv", "stretch").orderBy(F.col("turn").asc_nulls_last())
    numbered = write_stage(
        placed.withColumn("no", F.row_number().over(inside) + F.col("before_n_steps"))
        .select("conv", "stretch", "no", F.xxhash64("no", "n", "h1").alias("s1"),
                F.xxhash64("no", "n", "h2").alias("s2")), "chat-numbered")
    upto = (Window.partitionBy("conv", "stretch").orderBy("no")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rolled = _with_offsets(numbered, "chat-rolled", {"s1": F.bit_xor("s1"), "s2": F.bit_xor("s2")}, F.bit_xor)
    return rolled.select(
        "conv", F.col("no").cast("long").alias("no"),
        *[F.bit_xor(s).over(upto).bitwiseXOR(F.col(f"before_{s}")).alias(p) for s, p in (("s1", "p1"), ("s2", "p2"))])


def collapse_snapshots(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text", stretch: int = 1024) -> DataFrame:
    """One row per conversation: conv, n_turns (steps), kept.

    A conversation that is the beginning of a longer one is dropped; of equal
    ones the smallest id stays (null last).  Order counts, turn numbers don't.
    """
    prefixes = write_stage(prefix_hashes(conversations, conv, turn, role, text, stretch), "chat-prefixes")
    ends = write_stage(prefixes.groupBy("conv").agg(F.max(F.struct("no", "p1", "p2")).alias("e"))
                       .select("conv", "e.*"), "chat-ends")
    inner = (prefixes.join(ends.select(F.col("conv").alias("c"), F.col("no").alias("length")),
                           F.expr("conv <=> c and no < length"))
             .select("no", "p1", "p2").distinct())
    firsts = ends.groupBy("no", "p1", "p2").agg(F.min("conv").alias("first"))
    maximal = write_stage(firsts.join(inner, ["no", "p1", "p2"], "left_anti")
                          .withColumn("maximal", F.lit(True)), "chat-maximal")
    stays = F.coalesce(F.col("maximal") & F.col("conv").eqNullSafe(F.col("first")), F.lit(False))
    return (ends.join(maximal, ["no", "p1", "p2"], "left")
            .select("conv", F.col("no").alias("n_turns"), stays.alias("kept")))


def format_chats(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", stretch: int = 1024) -> DataFrame:
    """One row per conversation: id, n_turns, kept, chat (null where not kept).

    The chat has each turn as <|im_start|>role, its text and <|im_end|>, by turn
    number.  Null role or text reads as empty; null turns come last; rows
    repeated within a conversation count once; different rows with one turn
    number are one step, rendered by role, then text.  Rows without a
    conversation id are one conversation.  An empty table gives an empty result.
    Other columns are not read.  A chat is one string, so a kept conversation
    has to fit in one row.
    """
    marked = write_stage(collapse_snapshots(conversations, conv, turn, role, text, stretch), "chat-marked")
    kept = marked.where("kept").select(F.col("conv").alias("k"))
    rows = (conversations.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
                                 whole(F.col(role).cast("string")).alias("role"), whole(text).alias("text"))
            .join(kept, F.expr("conv <=> k"), "left_semi"))
    turns = F.array_distinct(F.sort_array(F.collect_list(F.struct(
        F.col("turn").isNull().alias("last"), "turn", "role", "text"))))
    chats = rows.groupBy(F.col("conv").alias("c")).agg(turns.alias("turns")).select(
        "c", F.array_join(F.transform("turns", lambda t: F.concat(
            F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE + "\n"))), "").alias("chat"))
    return (marked.join(chats, F.expr("conv <=> c"), "left")
            .select(F.col("conv").alias(conv), "n_turns", "kept", "chat"))
