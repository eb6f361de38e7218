"""Repair of conversation structure at the least cost, with a canonical audit.

A repaired conversation's role initials read ``(s?(ua)+)?``.  The automaton has
four states: nothing yet, after s, after u (open), after a.  Edits are arcs
between nodes (row, state); each edit's letter leaves a node by one arc at most.

Costs: conversations are cut into segments of at most SEGMENT rows.  A segment is
a 4 x 4 matrix of least costs from state to state, and matrices of neighbours
multiply, so a sweep up and down a tree of segments gives every segment the cost
still to come after it, however long its conversation is.

Audits: among the arcs of least cost, nodes are ranked by the first letter of
their least audit, then by the first 2, 4, 8, ... letters: the rank of 2k letters
is that of the pair (rank of k letters here, rank of k letters at the node that
those k letters lead to).  The pointers double alike, and following them from a
segment's entry writes down its least path.  A second sweep hands every segment
the state in which the least path enters it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from paneldeck.llm.order import in_order, numbered
from paneldeck.llm.text import WORD, bound_batches, stripped
from paneldeck.session import write_stage

SEGMENT_BITS = 10
FAN_BITS = 6
NEVER = 1 << 40
NODES = 400_000  # nodes that one pass holds, or one segment's

# Costs of the edits, and the role that may come next in each state.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NEXT = np.array([2, 2, 3, 2])
NEXT_ROLE = ("user", "user", "assistant", "user")
CLOSE = [0, 2 * INSERT, INSERT, 0]
CLOSE_AUDIT = ("", "II", "I", "")
CLASSES = "sua"
LETTERS = np.frombuffer(b"DIKR", dtype=np.uint8)  # ASCII order
# A row's code: its class (s, u, a or other) and its fault (none, blank, duplicate, truncated).
CODES = "ABCDEFGHIJKLMNOP"
LEGAL = ("su", "ua", "au")
WALKED = (StructType().add("costs", ArrayType(LongType())).add("exits", ArrayType(LongType()))
          .add("audits", ArrayType(StringType())))


# --- least costs and least paths of segments -----------------------------------

def consume_arcs() -> tuple[np.ndarray, np.ndarray]:
    """Costs and target states of D, K and R by code and state."""
    cost = np.full((len(CODES), 3, 4), NEVER, dtype=np.int64)
    target = np.zeros((len(CODES), 3, 4), dtype=np.int64)
    for code in range(len(CODES)):
        kind, fault = divmod(code, 4)
        for state in range(4):
            cost[code, 0, state], target[code, 0, state] = DELETE, state
            if fault not in (1, 2):
                extra = TRUNCATED if fault == 3 else 0
                if (kind == 0 and state == 0) or kind + 1 == NEXT[state]:
                    cost[code, 1, state], target[code, 1, state] = KEEP + extra, kind + 1
                cost[code, 2, state], target[code, 2, state] = REROLE + extra, NEXT[state]
    return cost, target


ARC_COST, ARC_TARGET = consume_arcs()


def to_come(codes: np.ndarray, after: np.ndarray, arcs: bool = False):
    """Least cost to come from each state before the first row.  ``codes`` is one
    row a segment, aligned at the right; with ``arcs`` also the costs of all nodes."""
    n, rows = codes.shape
    cost = np.empty((n, rows + 1, 4), dtype=np.int64) if arcs else None
    now = after
    if arcs:
        cost[:, rows] = now
    pick = np.arange(n)[:, None, None]
    for i in range(rows - 1, -1, -1):
        code = codes[:, i]
        eaten = (ARC_COST[code] + now[pick, ARC_TARGET[code]]).min(axis=1)
        one = np.minimum(eaten, INSERT + eaten[:, NEXT])
        now = np.minimum(np.minimum(eaten, INSERT + one[:, NEXT]), NEVER)
        if arcs:
            cost[:, i] = now
    return cost if arcs else now


def ranked(letter: np.ndarray, pointer: np.ndarray, steps: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of all nodes by their least audit, and the doubled pointers."""
    rank, pointers = letter.astype(np.int64), [pointer]
    for _ in range(max(steps - 1, 0).bit_length()):
        pair = rank * (int(rank.max()) + 1) + rank[pointers[-1]]
        rank = np.unique(pair, return_inverse=True)[1].reshape(-1)
        pointers.append(pointers[-1][pointers[-1]])
    return rank, pointers


def walk(codes: np.ndarray, lengths: np.ndarray, after: np.ndarray):
    """For each segment and entry state: cost to come, exit state, least audit."""
    n, rows = codes.shape
    cost = to_come(codes, after, arcs=True)
    node = np.arange(n * (rows + 1) * 4).reshape(n, rows + 1, 4)
    # Arcs of least cost in the order of their letters: D, I, K, R.
    eat = ARC_COST[codes]  # segment, row, edit, state
    target = ARC_TARGET[codes]
    ahead = cost[np.arange(n)[:, None, None, None], np.arange(1, rows + 1)[None, :, None, None], target]
    best = (eat + ahead == cost[:, :-1, None, :]) & (eat < NEVER)
    to = node[:, 1:, :1, None].transpose(0, 1, 3, 2) + target
    insert = INSERT + cost[:, :-1][:, :, NEXT] == cost[:, :-1]
    arcs = np.stack([best[:, :, 0], insert, best[:, :, 1], best[:, :, 2]], axis=2)
    ends = np.stack([to[:, :, 0], node[:, :-1][:, :, NEXT], to[:, :, 1], to[:, :, 2]], axis=2)
    first = arcs.argmax(axis=2)  # the least rank among the letters that lead on
    letter = np.zeros(node.shape, dtype=np.uint8)
    letter[:, :-1] = LETTERS[first]
    pointer = node.copy()
    pointer[:, :-1] = np.take_along_axis(ends, first[:, :, None, :], axis=2)[:, :, 0]
    _, pointers = ranked(letter.reshape(-1), pointer.reshape(-1), 3 * rows + 1)

    entry = node[np.arange(n), rows - lengths]
    path = entry.reshape(-1, 1)
    for p in pointers[:-1]:
        path = np.concatenate([path, p[path]], axis=1)
    exits = pointers[-1][entry] % 4
    audits = np.ascontiguousarray(letter.reshape(-1)[path]).view(f"S{path.shape[1]}").reshape(n, 4)
    return cost[np.arange(n), rows - lengths], exits, audits


def blocks(codes: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Segments of like length together: their places, codes aligned at the right,
    and lengths."""
    order = sorted(range(len(codes)), key=lambda i: len(codes[i]))
    while order:
        rows = len(codes[order[-1]])
        take = max(1, NODES // (4 * (rows + 1)))
        own, order = order[-take:], order[:-take]
        packed = np.zeros((len(own), rows), dtype=np.int64)
        for k, i in enumerate(own):
            packed[k, rows - len(codes[i]):] = np.frombuffer(codes[i].encode(), dtype=np.uint8) - ord(CODES[0])
        yield own, packed, np.array([len(codes[i]) for i in own])


@F.pandas_udf(ArrayType(LongType()))
def segment_matrix(codes: pd.Series) -> pd.Series:
    """Least costs from each state to each state, row by row."""
    out: list = [None] * len(codes)
    for own, packed, lengths in blocks(codes.tolist()):
        columns = []
        for state in range(4):
            goal = np.full((len(own), 4), NEVER, dtype=np.int64)
            goal[:, state] = 0
            columns.append(to_come_of(packed, lengths, goal))
        for k, i in enumerate(own):
            out[i] = np.stack([c[k] for c in columns], axis=1).reshape(-1).tolist()
    return pd.Series(out)


def to_come_of(packed: np.ndarray, lengths: np.ndarray, after: np.ndarray) -> np.ndarray:
    return to_come(packed, after, arcs=True)[np.arange(len(packed)), packed.shape[1] - lengths]


@F.pandas_udf(WALKED)
def segment_walk(codes: pd.Series, after: pd.Series) -> pd.DataFrame:
    out: list = [None] * len(codes)
    given = after.tolist()
    for own, packed, lengths in blocks(codes.tolist()):
        costs, exits, audits = walk(packed, lengths, np.array([given[i] for i in own], dtype=np.int64))
        for k, i in enumerate(own):
            out[i] = (costs[k].tolist(), exits[k].tolist(), [a.decode() for a in audits[k]])
    return pd.DataFrame(out, columns=["costs", "exits", "audits"])


# --- sweeps over the segments of long conversations ----------------------------

@F.pandas_udf(ArrayType(LongType()))
def product(matrices: pd.Series) -> pd.Series:
    def one(items) -> list[int]:
        out = np.array(items[0]).reshape(4, 4)
        for m in items[1:]:
            out = np.minimum((out[:, :, None] + np.array(m).reshape(1, 4, 4)).min(axis=1), NEVER)
        return out.reshape(-1).tolist()
    return matrices.map(one)


@F.pandas_udf(ArrayType(ArrayType(LongType())))
def costs_after(matrices: pd.Series, given: pd.Series) -> pd.Series:
    def one(items, after) -> list[list[int]]:
        out = [list(after)]
        for m in reversed(items[1:]):
            out.append(np.minimum((np.array(m).reshape(4, 4) + np.array(out[-1])).min(axis=1), NEVER).tolist())
        return out[::-1]
    return pd.Series([one(list(m), a) for m, a in zip(matrices, given)])


@F.pandas_udf(ArrayType(LongType()))
def chained(exits: pd.Series) -> pd.Series:
    def one(items) -> list[int]:
        at = list(range(4))
        for e in items:
            at = [int(e[s]) for s in at]
        return at
    return exits.map(one)


@F.pandas_udf(ArrayType(ArrayType(LongType())))
def states_before(exits: pd.Series, given: pd.Series) -> pd.Series:
    def one(items, entry) -> list[list[int]]:
        out = [[int(entry[0])]]
        for e in items[:-1]:
            out.append([int(e[out[-1][0]])])
        return out
    return pd.Series([one(list(e), g) for e, g in zip(exits, given)])


def sweep(leaves: DataFrame, combine, hand_down, start: Column) -> DataFrame:
    """conv, j, given for every segment: up a tree of runs of 2 ** FAN_BITS segments
    with ``combine``, then down again with ``hand_down``; the top is given ``start``.
    ``leaves``: conv, j, n, value."""
    fan = 1 << FAN_BITS

    def runs(level: DataFrame) -> DataFrame:
        return (level.where("n > 1").groupBy("conv", F.shiftright("j", FAN_BITS).alias("up"))
                .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("j", "value"))).alias("items")))

    levels = [leaves]
    while (levels[-1].agg(F.max("n")).first()[0] or 1) > 1:
        levels.append(write_stage(runs(levels[-1]).select(
            "conv", F.col("up").alias("j"), F.ceil(F.col("n") / fan).alias("n"), combine("items.value").alias("value")),
            "repair-level"))
    known = None
    for level in reversed(levels):
        done = level.where("n = 1").select("conv", "j", start.alias("given"))
        if known is not None:
            pair = F.explode(F.arrays_zip(F.col("items.j").alias("j"), F.col("handed").alias("given"))).alias("pair")
            below = (runs(level).join(known.withColumnRenamed("j", "up"), ["conv", "up"])
                     .withColumn("handed", hand_down("items.value", "given")).select("conv", pair).select("conv", "pair.*"))
            done = done.unionByName(below)
        known = done
    return known


# --- the operator ---------------------------------------------------------------

REPAIRED = "conv string, repaired_sha256 string"


def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each repaired conversation, from rows that follow its audit in
    order.  One running digest is held, not the conversation."""
    conv, audit, at, state, digest, lines = None, "", 0, 0, None, 0

    def line(role: str, text: str) -> None:
        nonlocal lines
        digest.update((("\n" if lines else "") + role + ":" + text).encode())
        lines += 1

    def inserts() -> None:
        nonlocal at, state
        while audit[at:at + 1] == "I":
            line(NEXT_ROLE[state], "")
            state, at = int(NEXT[state]), at + 1

    for batch in batches:
        done = []
        for key, own, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text"))):
            if own is not None:
                if digest is not None:
                    inserts()
                    done.append((conv, digest.hexdigest()))
                conv, audit, at, state, digest, lines = key, own, 0, 0, hashlib.sha256(), 0
                continue
            inserts()
            edit, at = audit[at], at + 1
            if edit == "R":
                line(NEXT_ROLE[state], text)
                state = int(NEXT[state])
            elif edit == "K":
                line(role, text)
                state = CLASSES.index(role[0]) + 1
        yield pa.RecordBatch.from_pydict({"conv": [d[0] for d in done], "repaired_sha256": [d[1] for d in done]},
                                         schema=pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())]))
    if digest is not None:
        inserts()
        yield pa.RecordBatch.from_pydict({"conv": [conv], "repaired_sha256": [digest.hexdigest()]})


def repair_conversations(turns: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    ``turns``: conv_id, turn, role, text.  ``conv_ids`` names conversations that
    are reported even without a turn.

    Null roles and texts count as one space; a null conv_id is a conversation of
    its own; null turns come first and leave no gap.  Rows of one turn are ordered
    by the SHA-256 of role and text; repeated rows are duplicates.  Conversations
    of any number of rows are cut into segments; only their own digest, which
    SHA-256 makes sequential, passes one task, row by row.  A conversation without
    rows has zeros, an empty audit and the digest of the empty text.  An empty
    table gives an empty result.  Other columns are not read.
    """
    spark = turns.sparkSession
    bound_batches(spark)
    kind = dict(turns.dtypes)["conv_id"]
    key = F.coalesce(F.concat(F.lit("1"), F.col("conv_id").cast("string")), F.lit("0"))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    sig = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    full = turns.select(key.alias("conv"), "turn", role.alias("role"), text.alias("text"), sig.alias("sig"))

    initial = F.substring("role", 1, 1)
    slim = full.select(
        "conv", "turn", F.unhex("sig").alias("sig"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("kind"),
        (~F.col("text").rlike(WORD)).alias("blank"), (~F.right(stripped(F.col("text")), F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.monotonically_increasing_id().alias("row"))
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("sig"), F.asc("row")]
    rows = write_stage(numbered(in_order(slim, order, "repair-order"), "conv").drop("row"), "repair-rows")
    firsts = rows.groupBy("conv", "sig").agg(F.min("j").alias("j")).select("conv", "j", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    judged = write_stage(rows.join(firsts, ["conv", "j"], "left").select(
        "conv", "j", "n", "turn", "kind", fault.alias("fault")), "repair-judged")

    count = lambda f: F.count_if(F.col("fault") == f)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    facts = judged.groupBy("conv").agg(gaps.alias("gaps"), count(1).alias("blank"), count(2).alias("duplicate"),
                                       count(3).alias("truncated"))

    code = F.substring(F.lit(CODES), F.col("kind") * 4 + F.col("fault") + 1, F.lit(1))
    segments = write_stage(
        judged.groupBy("conv", F.shiftright("j", SEGMENT_BITS).alias("seg"))
        .agg(F.ceil(F.first("n") / (1 << SEGMENT_BITS)).alias("n"),
             F.sort_array(F.collect_list(F.struct("j", code.alias("code"), "kind"))).alias("items"))
        .select("conv", F.col("seg").alias("j"), "n", F.array_join("items.code", "").alias("codes"),
                F.array_join(F.transform("items.kind", lambda k: F.substring(F.lit("sua-"), k + 1, F.lit(1))), "").alias("roles")),
        "repair-segments")

    close = F.array(*[F.lit(c).cast("long") for c in CLOSE])
    long = segments.where("n > 1")
    after = sweep(long.select("conv", "j", "n", segment_matrix("codes").alias("value")), product, costs_after, close)
    walked = write_stage(
        segments.where("n = 1").select("*", close.alias("given")).unionByName(long.join(after, ["conv", "j"]))
        .withColumn("least", segment_walk("codes", "given")).select("conv", "j", "n", "least.*"), "repair-walked")
    zero = F.array(F.lit(0).cast("long"))
    many = walked.where("n > 1")
    entry = sweep(many.select("conv", "j", "n", F.col("exits").alias("value")), chained, states_before, zero)
    entered = walked.where("n = 1").select("*", zero.alias("given")).unionByName(many.join(entry, ["conv", "j"]))
    state = F.col("given")[0].cast("int")
    tail = F.element_at(F.array(*[F.lit(a) for a in CLOSE_AUDIT]), F.element_at("exits", state + 1).cast("int") + 1)
    piece = F.concat(F.element_at("audits", state + 1), F.when(F.col("j") == F.col("n") - 1, tail).otherwise(""))
    audits = entered.groupBy("conv").agg(
        F.max(F.when(F.col("j") == 0, F.element_at("costs", 1))).alias("cost"),
        F.array_join(F.sort_array(F.collect_list(F.struct("j", piece.alias("piece"))))["piece"], "").alias("audit"))

    pairs = F.transform(F.sequence(F.lit(1), F.length("roles") - 1), lambda i: F.substring("roles", i, F.lit(2)))
    inner = segments.select("conv", F.when(F.length("roles") > 1, F.size(F.filter(pairs, lambda p: ~p.isin(*LEGAL))))
                            .otherwise(0).alias("illegal"))
    border = (long.select("conv", (F.col("j") + 1).alias("j"), F.right("roles", F.lit(1)).alias("last"))
              .join(long.select("conv", "j", F.left("roles", F.lit(1)).alias("head")), ["conv", "j"])
              .select("conv", (~F.concat("last", "head").isin(*LEGAL)).cast("int").alias("illegal")))
    illegal = inner.unionByName(border).groupBy("conv").agg(F.sum("illegal").alias("illegal"))

    known = full.select("conv")
    if conv_ids is not None:
        known = known.unionByName(conv_ids.select(key.alias("conv")))
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    heads = write_stage(known.distinct().join(facts, "conv", "left").join(illegal, "conv", "left")
                        .join(audits, "conv", "left").fillna({**zeros, "audit": ""}), "repair-heads")

    nothing = lambda c, t: F.lit(None).cast(t).alias(c)
    turn_type = dict(turns.dtypes)["turn"]
    script = heads.select("conv", "audit", nothing("turn", turn_type), nothing("sig", "string"), nothing("role", "string"),
                          nothing("text", "string")).unionByName(full.withColumn("audit", nothing("audit", "string")))
    digests = (script.repartition("conv")
               .sortWithinPartitions("conv", F.asc(F.col("audit").isNull()), F.asc_nulls_first("turn"), "sig")
               .select("conv", "audit", "role", "text").mapInArrow(replay, REPAIRED))
    conv_id = F.when(F.col("conv") != "0", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id")
    return heads.join(digests, "conv").select(conv_id, *[F.col(c).cast("long").alias(c) for c in zeros], "audit",
                                              "repaired_sha256")
