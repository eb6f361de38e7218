"""Exact Jaccard join of documents' word shingles by PartEnum signatures.

Sets are collapsed to one representative first.  A set of size s belongs to the
size band that ends at the next power of two R, and to the next band as well if a
partner could lie there.  Two sets of a band with J >= threshold differ in at
most (1 - t) / (1 + t) * (a + b) features.  In each band the feature domain is
hashed into more partitions than that, so at least one partition is left
untouched: both sets hold the same features in it and share its signature.  A set
emits its non-empty partitions in one common order, one more than a partner can
touch; a set with fewer (small or unlucky) also emits its empty partitions, so no
link is lost.

Candidates are never all pairs of a group.  First members are paired with a
leader of their group only; verified links give components, and groups that lie
in one component are done.  Groups that still span several are compared, each set
of members once, in blocks of bounded size: a pair in the first signature that
both are known to hold, through a parity sketch whose distance is at most the true
one, so that no linked pair is turned away.  What passes is verified on the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneldeck.llm.components import connected_components
from paneldeck.llm.text import bound_batches, fresh, whole
from paneldeck.session import write_stage

BLOCK = 1_000
STAR_ROUNDS = 2
SKETCH_BITS = 512
FIRST = 16


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """splitmix64 of each value."""
    x = x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# One odd multiplier for each place in a shingle.
MULTIPLIERS = mixed(np.arange(64, dtype=np.uint64), 11) | np.uint64(1)


# A random value for each byte at each of 64 places in a word, and the bytes that words have.
BYTES = mixed(np.arange(64 * 256, dtype=np.uint64), 12)
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[9, 10, 11, 12, 13, 32]] = False
STRETCH = 1 << 18


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each word: the sum of its bytes' values by place.  Long texts are
    read in stretches; a word that goes on in the next one is summed over both."""
    out, held = [], 0  # held: bytes of a word that is still open
    for start in range(0, len(data), STRETCH):
        part = np.frombuffer(data, np.uint8, min(STRETCH, len(data) - start), start)
        at = np.flatnonzero(IN_WORD[part])
        if not len(at):
            held = 0
            continue
        heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
        lengths = np.diff(heads, append=len(at))
        place = np.arange(len(at)) - np.repeat(heads, lengths)
        before = held if at[0] == 0 else 0
        place[:lengths[0]] += before
        values = BYTES[(place & 63) << 8 | part[at]]
        far = np.flatnonzero(place > 63)
        if len(far):
            values[far] *= mixed((place[far] >> 6).astype(np.uint64), 13) | np.uint64(1)
        sums = np.add.reduceat(values, heads)
        held = 0 if at[-1] < len(part) - 1 else int(lengths[-1]) + (before if len(heads) == 1 else 0)
        if before:
            out[-1][-1:] += sums[:1]
            sums = sums[1:]
        if len(sums):
            out.append(sums)
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def shingle_set(text: str, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle."""
    w = word_hashes(text.encode("utf-8", "surrogatepass").lower())  # lower() of bytes: ASCII only
    n = len(w)
    if n == 0:
        return w
    span = min(n, width)
    made = np.full(n - span + 1, span, dtype=np.uint64)
    for i in range(span):
        made += w[i:n - span + 1 + i] * MULTIPLIERS[i]
    made = np.sort(mixed(made))
    return made[np.concatenate([[True], made[1:] != made[:-1]])]


class Bands:
    """Bands and signatures for one threshold, given in per cent."""

    def __init__(self, percent: int):
        self.percent = percent

    def most_apart(self, a, b):
        """Features in which two linked sets of sizes a and b differ at most."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def levels(self, size: int) -> list[int]:
        """Exponents of the bands of a set."""
        own = (size - 1).bit_length()
        return [own, own + 1] if 100 * size >= self.percent * ((1 << own) + 1) else [own]

    def partitions(self, level: int) -> int:
        """Enough that a set leaves more of them non-empty than a partner touches."""
        return int(1.1 * self.most_apart(1 << level, 1 << level)) + 4

    def signatures(self, features: np.ndarray, level: int, drawn: tuple | None = None) -> np.ndarray:
        """Of a set in a band; the lowest bit is that of the band's exponent.
        ``drawn``: two hashes of the features, where they are at hand.

        A partner touches ``touched`` partitions at most.  Of the non-empty ones that two
        linked sets share, each set has fewer than that many and one before the first in
        the common order, so the first ``touched`` + 1 of each set suffice."""
        place, value = drawn or (mixed(features, 1) >> np.uint64(32), mixed(features, 2))
        n = self.partitions(level)
        at = (place * np.uint64(n)) >> np.uint64(32)
        order = np.argsort(at.astype(np.uint16) if n <= 1 << 16 else at, kind="stable")
        at = at[order]
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        size = len(features)
        touched = self.most_apart(size, min(1 << level, 100 * size // self.percent))
        first = starts[:touched + 1]
        end = starts[touched + 1] if len(starts) > touched + 1 else size
        sums = np.add.reduceat(value[order[:end]], first)
        where = at[first] + np.uint64(level << 40)
        found = mixed(sums ^ mixed(where, 3), 4)
        if len(starts) <= touched:
            empty = np.setdiff1d(np.arange(n, dtype=np.uint64), at[starts]) + np.uint64(level << 40)
            found = np.concatenate([found, mixed(mixed(empty, 3), 5)])
        return found & np.uint64(0xFFFFFFFFFFFFFFFE) | np.uint64(level & 1)

    def all_signatures(self, features: np.ndarray) -> np.ndarray:
        """Of a set in all its bands."""
        drawn = mixed(features, 1) >> np.uint64(32), mixed(features, 2)
        return np.concatenate([self.signatures(features, level, drawn) for level in self.levels(len(features))])

    def sketches(self, features: np.ndarray) -> list[bytes]:
        """In each band of a set, the parity of how many features fall on each bit: two
        sketches differ in as many bits as the sets in features, or fewer.  Small sets
        get more bits each, as chance counts for more there."""
        if not len(features):
            return []
        place, out = mixed(features, 6) >> np.uint64(32), []
        for level in self.levels(len(features)):
            bits = max(SKETCH_BITS, 1 << level)
            at = place * np.uint64(bits) >> np.uint64(32)
            out.append(np.packbits(np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes())
        return out


def own_level(n: str) -> Column:
    """Exponent of the smallest band of a set of n features."""
    return F.when(F.col(n) > 1, F.length(F.bin(F.col(n) - 1))).otherwise(0)


def shingle_keys(docs: DataFrame, id_col: str, text_col: str, width: int, bands: Bands) -> DataFrame:
    """id, n, k1, k2, own, next: size and 128-bit key of each document's set, and
    its sketches in its bands."""
    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                s = shingle_set(text, width)
                rows.append((len(s), s.sum(dtype=np.uint64), mixed(s, 9).sum(dtype=np.uint64), *bands.sketches(s),
                             None, None))
            column = lambda i: [r[i] for r in rows]
            yield pd.DataFrame({"id": batch["id"], "n": column(0), "k1": np.array(column(1), np.uint64).view(np.int64),
                                "k2": np.array(column(2), np.uint64).view(np.int64), "own": column(3), "next": column(4)})

    return docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text")).mapInPandas(
        keys, "id long, n long, k1 long, k2 long, own binary, next binary")


def set_signatures(docs: DataFrame, width: int, bands: Bands) -> DataFrame:
    """id, sig: a row for each signature of each document's set."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 64):
                part = batch.iloc[start:start + 64]
                ids, sigs = [], []
                for doc, text in zip(part["id"], part["text"]):
                    features = shingle_set(text, width)
                    if len(features):
                        sigs.append(bands.all_signatures(features))
                        ids.append(np.full(len(sigs[-1]), doc, dtype=np.int64))
                if ids:
                    yield pd.DataFrame({"id": np.concatenate(ids), "sig": np.concatenate(sigs).view(np.int64)})

    return docs.mapInPandas(rows, "id long, sig long")


def set_features(docs: DataFrame, width: int) -> DataFrame:
    """id, features: the sets themselves."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 64):
                part = batch.iloc[start:start + 64]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "features": [
                    shingle_set(t, width).view(np.int64) for t in part["text"]]})

    return docs.mapInPandas(rows, "id long, features array<long>")


def verified(pairs: DataFrame, texts: DataFrame, width: int, bands: Bands) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold, counted on the sets of the
    documents that the pairs name."""
    percent = bands.percent

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            both = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * both >= percent * (len(x) + len(y) - both)
        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=bool)

    pairs = write_stage(pairs.select("a", "b"), "jaccard-pairs")
    named = write_stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "jaccard-named")
    sets = write_stage(set_features(texts.join(named, "id", "left_semi"), width), "jaccard-sets")
    side = lambda name: sets.select(F.col("id").alias(name), F.col("features").alias("f" + name))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(linked("fa", "fb")).select("a", "b")


def near(pairs: DataFrame, sketches: DataFrame, bands: Bands) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out."""
    @F.pandas_udf("boolean")
    def close(na: pd.Series, nb: pd.Series, xa: pd.Series, xb: pd.Series) -> pd.Series:
        def one(n, m, x, y):
            apart = np.bitwise_count(np.frombuffer(x, np.uint8) ^ np.frombuffer(y, np.uint8)).sum()
            return apart <= bands.most_apart(n, m)
        return pd.Series([one(*v) for v in zip(na, nb, xa, xb)], dtype=bool)

    side = lambda x: sketches.select(*[F.col(c).alias(c + x) for c in ("id", "n", "own", "next")])
    level = lambda x: own_level("n" + x)
    joined = (pairs.join(side("a"), F.col("a") == F.col("ida")).join(side("b"), F.col("b") == F.col("idb"))
              .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * bands.percent))
    pick = lambda x, y: F.when(level(x) >= level(y), F.col("own" + x)).otherwise(F.col("next" + x))
    return (joined.withColumn("xa", pick("a", "b")).withColumn("xb", pick("b", "a"))
            .where(close("na", "nb", "xa", "xb")).select("a", "b"))


def compare_blocks(rows: DataFrame, bands: Bands) -> DataFrame:
    """a, b: pairs of different components within each (sig, i, j) that sizes and
    sketches don't rule out.  ``rows``: sig, i, j, id, label, block, n, sketch, first,
    in groups of bounded size; where i < j the two blocks are compared across.

    A pair is left to a smaller signature that both rows have among their first
    ones.  The smallest that both hold never is, so each pair is given, mostly once."""
    def pairs(rows: pd.DataFrame, group: np.ndarray) -> Iterator[pd.DataFrame]:
        """All groups of ``rows`` at once: each row against the one k rows on, for
        every k at which a group still has rows."""
        sig, ids, labels, n, block = (rows[c].to_numpy() for c in ("sig", "id", "label", "n", "block"))
        across = (rows["i"] != rows["j"]).to_numpy()
        width = np.array([len(x) for x in rows["sketch"]])
        drawn = {}  # width -> (place of a row in the matrix or -1, sketches)
        for size in set(width.tolist()):
            has = width == size
            drawn[size] = (np.where(has, np.cumsum(has) - 1, -1), np.frombuffer(
                b"".join(x for x, h in zip(rows["sketch"], has) if h), dtype=np.uint64).reshape(has.sum(), -1))
        heads = rows["first"].to_numpy()

        def seen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Whether both rows name a signature before this one."""
            used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            named = np.full((len(used), FIRST), np.iinfo(np.int64).max)
            for place, row in enumerate(used):
                named[place, :len(heads[row])] = heads[row]
            x, y, here = named[at[:len(a)]], named[at[len(a):]], sig[a][:, None]
            out = np.zeros(len(a), dtype=bool)
            for i in range(FIRST):
                out |= ((x[:, i, None] == y) & (x[:, i, None] < here)).any(axis=1)
            return out

        first, k, found, held = np.arange(len(ids)), 0, [], 0
        while len(first):
            k += 1
            first = first[first + k < len(ids)]
            first = first[group[first] == group[first + k]]
            x, y = first, first + k
            fits = (labels[x] != labels[y]) & ~(across[x] & (block[x] == block[y])) & (width[x] == width[y])
            fits &= np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * bands.percent
            x, y = x[fits], y[fits]
            at = width[x]
            for size in set(at.tolist()):
                place, bits = drawn[size]
                here = np.flatnonzero(at == size)
                for part in np.array_split(here, 1 + len(here) * bits.shape[1] // 1_000_000):
                    a, b = x[part], y[part]
                    apart = np.bitwise_count(bits[place[a]] ^ bits[place[b]]).sum(axis=1)
                    near = apart <= bands.most_apart(n[a], n[b])
                    a, b = a[near], b[near]
                    if not len(a):
                        continue
                    new = ~seen(a, b)
                    found.append((ids[a[new]], ids[b[new]]))
                    held += len(found[-1][0])
            if found and (held > 500_000 or not len(first)):
                a, b = (np.concatenate(f) for f in zip(*found))
                found, held = [], 0
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            key = batch[["sig", "i", "j"]].to_numpy()
            new = np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])
            end = np.flatnonzero(new)[-1]  # the last group may go on in the next batch
            yield from pairs(batch.iloc[:end], np.cumsum(new)[:end])
            rest = batch.iloc[end:]
        if rest is not None and len(rest):
            yield from pairs(rest, np.zeros(len(rest)))

    keys = ["sig", "i", "j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(scan, "a long, b long")


def with_leaders(rows: DataFrame, turn: Column) -> DataFrame:
    """sig, id, label, leader, leads of the groups that span several components:
    the member with the highest ``turn`` and its label.  ``rows``: sig, id, label."""
    leaders = rows.withColumn("turn", turn).groupBy("sig").agg(
        F.max(F.struct("turn", "id", "label")).alias("top"), F.min("label").alias("x"), F.max("label").alias("y"))
    return rows.select("sig", "id", "label").join(
        leaders.where("x <> y").select("sig", F.col("top.id").alias("leader"), F.col("top.label").alias("leads")), "sig")


def star_pairs(led: DataFrame) -> DataFrame:
    """a, b: each member of another component than its group's leader with the
    leader that it shares the most groups with; one pair for a member at most."""
    shared = led.where("label <> leads").groupBy("id", "leader").agg(F.count(F.lit(1)).alias("n"))
    best = shared.groupBy("id").agg(F.max(F.struct("n", "leader")).alias("best"))
    return write_stage(best.select(F.least("id", "best.leader").alias("a"), F.greatest("id", "best.leader").alias("b"))
                       .distinct(), "jaccard-stars")


def shared_signatures(docs: DataFrame, id_col: str, text_col: str, width: int,
                      bands: Bands) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, texts, members, sketches): id, n, rep of every document, where rep has
    the same set and the smallest id; id, text; sig, id of the signatures that
    several representatives hold; sizes and sketches by id."""
    bound_batches(docs.sparkSession)
    keys = write_stage(shingle_keys(docs, id_col, text_col, width, bands), "jaccard-keys")
    named = keys.where("id is not null and n > 0")
    reps = write_stage(named.groupBy("k1", "k2").agg(F.min("id").alias("rep")), "jaccard-reps")
    rows = write_stage(keys.join(reps, ["k1", "k2"], "left").select(
        "id", "n", F.when(F.col("n") > 0, F.col("rep")).alias("rep")), "jaccard-rows")
    copies = write_stage(rows.where("id <> rep").select("id").distinct()
                         .join(reps.select(F.col("rep").alias("id")), "id", "left_anti"), "jaccard-copies")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text")).where("id is not null")

    by_sig = Window.partitionBy("sig").orderBy("id")
    grouped = (set_signatures(texts.join(copies, "id", "left_anti"), width, bands)
               .withColumn("before", F.lag("id").over(by_sig)).withColumn("after", F.lead("id").over(by_sig))
               .where("before <> id or after <> id"))
    members = write_stage(grouped.select("sig", "id"), "jaccard-members")
    return rows, texts, members, keys.select("id", "n", "own", "next").where("id is not null and n > 0")


def dealt_blocks(labelled: DataFrame, sketches: DataFrame) -> DataFrame:
    """The rows of ``compare_blocks`` from sig, id, label: of the groups that span
    several components one for each set of members, each row with the sketch of the
    group's band and the first signatures of its document among those groups."""
    # An id of several rows may have sets in different bands: its groups stay as they are.
    several = sketches.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(
        "id", F.lit(True).alias("several"))
    marked = labelled.join(several, "id", "left")
    half = lambda salt, bits: F.sum(
        F.shiftrightunsigned(F.xxhash64("id", F.lit(salt)), bits).bitwiseAND(0xFFFFFFFF))
    groups = (marked.groupBy("sig").agg(
        F.count(F.lit(1)).alias("held"), F.min("label").alias("x"), F.max("label").alias("y"),
        half(0, 0).alias("p"), half(0, 32).alias("q"), half(1, 0).alias("r"), half(1, 32).alias("s"),
        F.max("several").alias("several"))
        .where("x <> y").withColumn("alone", F.when(F.col("several"), F.col("sig")))
        .groupBy("held", "p", "q", "r", "s", "alone").agg(F.min("sig").alias("sig"))
        .select("sig", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks")))
    opened = write_stage(marked.join(groups, "sig"), "jaccard-open")
    first = (opened.where("several is null").groupBy("id")
             .agg(F.slice(F.array_sort(F.collect_list("sig")), 1, FIRST).alias("first")))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (opened.withColumn("block", block)
             .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("sig", "id", "label", "block", F.least("block", "other").alias("i"),
                     F.greatest("block", "other").alias("j")))
    sketch = F.when(F.col("sig").bitwiseAND(1) == own_level("n").bitwiseAND(1), F.col("own")).otherwise(F.col("next"))
    held = F.coalesce("first", F.array().cast("array<long>"))
    return (dealt.join(sketches, "id").withColumn("sketch", sketch).where("sketch is not null").drop("own", "next")
            .join(first, "id", "left").withColumn("first", held))


def jaccard_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                  percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(rows, pairs): rows as in ``jaccard_links``, and every linked pair a < b of
    representatives, m (m - 1) / 2 of them for m texts that all link.  For
    components alone ``jaccard_links`` compares far fewer."""
    bands = Bands(percent)
    rows, texts, members, sketches = shared_signatures(docs, id_col, text_col, width, bands)
    dealt = dealt_blocks(members.withColumn("label", F.col("id")), sketches)
    near_pairs = write_stage(compare_blocks(dealt, bands).distinct(), "jaccard-all-near")
    return rows, write_stage(verified(near_pairs, texts, width, bands).distinct(), "jaccard-all-pairs")


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                  percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(rows, links): id, n, rep of every document, where rep has the same set and
    the smallest id, and links (a, b) between such representatives that connect
    all that are linked, directly or through others."""
    bands = Bands(percent)
    rows, texts, members, sketches = shared_signatures(docs, id_col, text_col, width, bands)

    # Stars first.  The leaders of the first round are the members that share the
    # most signatures, which near copies of one text have its least changed copy
    # for; later rounds draw them anew for what is still apart.
    central = write_stage(members.groupBy("id").agg(F.count(F.lit(1)).alias("turn")), "jaccard-weights")
    links = None
    labelled = write_stage(members.join(central, "id").select("sig", "id", "turn"),
                           "jaccard-weighted").withColumn("label", F.col("id"))
    for turn in range(STAR_ROUNDS):
        led = with_leaders(labelled, F.xxhash64("id", F.lit(turn)) if turn else F.col("turn"))
        if turn:  # at first all groups are open
            led = labelled = write_stage(led, "jaccard-led")
        found = verified(near(star_pairs(led), sketches, bands), texts, width, bands)
        links = write_stage(found if links is None else links.unionByName(found), "jaccard-star-links")
        labels = write_stage(connected_components(links), "jaccard-labels")
        labelled = write_stage(labelled.select("sig", "id").join(labels.withColumnRenamed("v", "id"), "id", "left")
                               .select("sig", "id", F.coalesce("label", "id").alias("label")), "jaccard-labelled")

    # what the stars have left open: groups that span several components
    dealt = dealt_blocks(labelled, sketches)
    more = write_stage(compare_blocks(dealt, bands).distinct(), "jaccard-open-pairs")
    return rows, write_stage(links.unionByName(verified(more, texts, width, bands)), "jaccard-links")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                       percent: int = 75) -> DataFrame:
    """One row per document: id, n_shingles, component_id.

    A document's set: its distinct shingles of ``width`` words (A-Z lower-cased);
    with fewer words, all of them as one.  Two documents link when 100 times the
    intersection is ``percent`` times the union or more; component_id is the
    smallest id reachable by links.

    Null text or a text without words: no shingles, its own component.  Rows
    without an id can't be named in a link: their component_id is null.  Rows that
    repeat an id are one document that links as each of them does.  An empty table
    gives an empty result.  Other columns are not read.  Shingles are compared by
    64-bit hash, sets by 128-bit key.
    """
    rows, links = jaccard_links(docs, id_col, text_col, width, percent)
    several = rows.where("rep is not null").groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    labels = write_stage(connected_components(
        links.unionByName(several.where("a < b").select("a", "b"))), "jaccard-components")
    return (rows.join(labels, F.col("rep") == F.col("v"), "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("label", "rep", "id").alias("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                     percent: int = 75) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id
    (one row of it, if rows repeat that id).  Rows without an id all stay."""
    found = jaccard_components(docs, id_col, text_col, width, percent)
    name, = fresh(docs, "_stay")
    stay = write_stage(found.where(F.col(id_col) == F.col("component_id"))
                       .select(F.col(id_col).alias(name)).distinct(), "jaccard-stay")
    named = docs.join(stay, F.col(id_col).cast("long") == F.col(name), "left_semi").dropDuplicates([id_col])
    return named.unionByName(docs.where(F.col(id_col).isNull()))
