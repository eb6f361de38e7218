"""Token ids in compressed binary files.

Ids are coded by one canonical Huffman code of limited length, made from the
counts of all documents.  Files hold frames of whole documents in ascending id
order; a frame's bits are cut into blocks of BLOCK ids, and the bit offset at
which each block starts is a checkpoint, so all blocks decode side by side with
one table look-up for each id.

A file set is a folder with two Parquet tables.  ``codebook``: id, bits (the code
lengths; canonical codes follow from them).  ``frames``: shard and seq (their order
is that of the documents), first (ids of the shard before the frame), doc_ids,
lengths, checkpoints (unsigned 64-bit, little endian) and bits (64-bit words, big
endian, codes from the top bit on).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneldeck.llm.memo import ByteMemo, IdStore, gathered
from paneldeck.llm.text import bound_batches, whole
from paneldeck.session import stage_path

BLOCK = 256
FRAME_IDS = 65_536
CODE_BITS = 16
ENCODE_BYTES = 1 << 20

IDS = "id long, row long, ids binary"
FRAMES = ("shard int, seq long, first long, doc_ids array<long>, lengths array<long>, checkpoints binary, bits binary")


# --- the code -----------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = CODE_BITS) -> np.ndarray:
    """Code lengths of least total size, none above ``limit`` (package-merge); 0
    for ids that do not occur.  ``limit`` grows where the ids need more."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.int64)
    if len(used) < 2:
        out[used] = 1
        return out
    limit = max(limit, int(len(used) - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.int64)
    packages, from_leaf = np.zeros(0, dtype=np.int64), []
    for _ in range(limit):
        pool = np.concatenate([weights, packages])
        order = np.argsort(pool, kind="stable")
        from_leaf.append(order < len(weights))
        pool = pool[order]
        pairs = len(pool) // 2
        packages = pool[:2 * pairs:2] + pool[1:2 * pairs:2]
    lengths = np.zeros(len(used), dtype=np.int64)
    taken = 2 * len(used) - 2
    for leaf in reversed(from_leaf):
        leaves = int(leaf[:taken].sum())
        lengths[:leaves] += 1
        taken = 2 * (taken - leaves)
    out[used] = lengths
    return out


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes by id (64 bits, aligned at the left), ids by code, and the longest
    length: codes of one length ascend by id, shorter ones come first."""
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    top = int(lengths.max()) if len(used) else 1
    spans = np.left_shift(1, top - lengths[used])
    starts = np.cumsum(spans) - spans
    codes = np.zeros(len(lengths), dtype=np.uint64)
    codes[used] = starts.astype(np.uint64) << np.uint64(64 - top)
    return codes, used, top


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """The checkpoints and the bits of the ids; ``codes`` are aligned at the left."""
    size = lengths[ids]
    ends = np.cumsum(size)
    at = ends - size
    words = np.zeros((int(ends[-1]) >> 6) + 1 if len(ids) else 0, dtype=np.uint64)
    if len(ids):
        code, word, shift = codes[ids], at >> 6, at & 63
        inside = code >> shift.view(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] = np.bitwise_or.reduceat(inside, first)
        over = np.flatnonzero(shift + size > 64)
        words[word[over] + 1] |= code[over] << (64 - shift[over]).view(np.uint64)
    return at[::BLOCK].astype("<u8").tobytes(), words.astype(">u8").tobytes()


class Decoder:
    """Table-driven decoding: the next bits give id and length at once."""

    def __init__(self, lengths: np.ndarray):
        _, used, self.top = canonical(lengths)
        spans = np.left_shift(1, self.top - lengths[used])
        self.table = np.ones(1 << self.top, dtype=np.int64)
        self.table[:spans.sum()] = np.repeat((used << 8) | lengths[used], spans)

    def unpack(self, frames: list[tuple[int, bytes, bytes]]) -> list[np.ndarray]:
        """The ids of each frame (count, checkpoints, bits); the blocks of all
        frames are decoded side by side."""
        starts, base, blocks = [np.zeros(0, dtype=np.int64)], 0, []
        for _, checkpoints, bits in frames:
            own = np.frombuffer(checkpoints, dtype="<u8").astype(np.int64)
            starts.append(own + 8 * base)
            blocks.append(len(own))
            base += len(bits)
        at = np.concatenate(starts)
        spare = bytes(BLOCK * self.top // 8 + 8)  # the last block of a frame may run on
        data = np.frombuffer(b"".join([*(bits for _, _, bits in frames), spare]), dtype=np.uint8)
        ahead = data[:-3].astype(np.uint32)  # the 32 bits from each byte on
        for i in range(1, 4):
            ahead <<= np.uint32(8)
            ahead |= data[i:len(data) - 3 + i]
        out = np.empty((BLOCK, len(at)), dtype=np.uint32)
        down = np.uint32(32 - self.top)
        for i in range(BLOCK):
            seen = ahead[at >> 3] << (at & 7).astype(np.uint32)
            entry = self.table[seen >> down]
            out[i] = entry >> 8
            at = at + (entry & 255)
        ids, done, first = out.T, [], 0
        for (n, _, _), k in zip(frames, blocks):
            done.append(ids[first:first + k].reshape(-1)[:n])
            first += k
        return done


# --- tasks --------------------------------------------------------------------

# White space in UTF-8 other than ASCII's.  Next to it, a cut before ASCII white space
# could part what the tokenizer's pattern keeps together.
OTHER_SPACE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
WINDOW = 1 << 17  # pieces looked up at once
TOGETHER = 64  # pieces in one text of the library
LETTER, MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
MARK[33:127] = True
MARK[48:58] = False
MARK &= ~LETTER
# Second bytes of the letters that UTF-8 writes with 0xC3 (Latin-1's, without its signs).
LATIN = np.zeros(256, dtype=bool)
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False


class PieceEncoder:
    """Ids of whole texts.  A byte-level tokenizer with the usual pattern never
    joins a character to ASCII white space behind it, so texts are cut there and
    the library encodes each distinct piece once, many in one call.  Pieces of up
    to KEY bytes are remembered by their exact bytes, at most ``room`` of them.  The
    pattern ends a token between a letter and a mark, so the marks that end a new
    piece are looked up apart, and the word before them is often known.  Longer pieces, texts with other white space and any other tokenizer's texts go
    to the library whole.
    """

    def __init__(self, source: str, end_id: int, kind: str, room: int = 1 << 20):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind, self.end_id, self.room = kind, end_id, room
        spec = json.loads(source)
        pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        self.by_piece = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"]) for a in added))
        if hasattr(self.library.model, "_resize_cache"):
            self.library.model._resize_cache(0)  # pieces are remembered here
        if self.by_piece:  # a byte-level token has one character for each byte
            vocab = spec["model"]["vocab"]
            self.size = np.zeros(max([*vocab.values(), *(a["id"] for a in added)]) + 1, dtype=np.int64)
            for token, i in vocab.items():
                self.size[i] = len(token)
            for a in added:
                self.size[a["id"]] = len(a["content"].encode())
        self.mark = MARK.copy()  # those of an added token stay with their word
        self.mark[list("".join(a["content"] for a in added).encode())] = False
        self.memo, self.store = ByteMemo(room), IdStore(np.array([end_id], dtype=kind))

    def whole(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.kind)
                for e in self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces encoded in texts of TOGETHER pieces (the library's time for a
        piece grows with its text), and where each one's ids end: a line end, a token
        of its own, parts a piece that begins without white space from the one before."""
        parts = np.array([not SPACE[p[0]] for p in pieces], dtype=np.int64)
        parted = [b"\n" + p if q else p for p, q in zip(pieces, parts.tolist())]
        ids = np.concatenate(self.whole([b"".join(parted[i:i + TOGETHER]) for i in range(0, len(parted), TOGETHER)]))
        ends = np.concatenate([[0], np.cumsum(self.size[ids])])
        stop = np.cumsum(np.array([len(p) for p in pieces]) + parts)
        start = np.concatenate([[0], stop[:-1]]) + parts
        low, high = np.searchsorted(ends, start), np.searchsorted(ends, stop)
        if ends[-1] != stop[-1] or (ends[low] != start).any() or (ends[high] != stop).any():
            each = self.whole(pieces)
            return np.concatenate(each), np.cumsum([len(e) for e in each])
        own = np.ones(len(ids), dtype=bool)
        own[low[parts > 0] - 1] = False
        return ids[own], high - np.cumsum(parts)

    def word_ends(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Where the marks begin that end a piece and follow a letter; its end if there are none."""
        cut = stop.copy()
        more = np.arange(len(cut))
        while len(more := more[(cut[more] > start[more]) & self.mark[data[cut[more] - 1]]]):
            cut[more] -= 1
        last, before = data[np.maximum(cut - 1, 0)], data[np.maximum(cut - 2, 0)]
        letter = ((cut > start) & LETTER[last]) | ((cut > start + 1) & (before == 0xC3) & LATIN[last])
        return np.where(letter, cut, stop)

    def look_up(self, blob: bytes, data: np.ndarray, start: np.ndarray, stop: np.ndarray,
                apart: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a window of pieces, and where each one's ids end; an empty piece
        stands for the end id.  ``apart``: marks at the end of new pieces are looked up apart."""
        def learn(new: np.ndarray) -> np.ndarray:
            useful = ~SPACE[data[stop[new] - 1]]
            low, high = start[new[useful]], stop[new[useful]]
            cut = self.word_ends(data, low, high) if apart else high
            two = np.flatnonzero(cut < high)
            if len(two):
                ids, ends = self.look_up(blob, data, np.stack([low[two], cut[two]], axis=1).reshape(-1),
                                         np.stack([cut[two], high[two]], axis=1).reshape(-1), apart=False)
            one = np.flatnonzero(cut == high)
            if len(one):
                alone, upto = self.together([blob[a:b] for a, b in zip(low[one].tolist(), high[one].tolist())])
            if len(two) and len(one):  # in the order of the pieces again
                count = np.zeros(len(cut), dtype=np.int64)
                place = np.zeros(len(cut), dtype=np.int64)
                count[two], count[one] = np.diff(ends[1::2], prepend=0), np.diff(upto, prepend=0)
                place[two], place[one] = ends[1::2] - count[two], len(ids) + upto - count[one]
                self.store.add(np.concatenate([ids, alone])[gathered(place, count)], count)
            elif len(two):
                self.store.add(ids, np.diff(ends[1::2], prepend=0))
            elif len(one):
                self.store.add(alone, np.diff(upto, prepend=0))
            return useful

        row = self.memo.rows(data, start, stop, learn)
        known = row >= 0
        places, counts = np.zeros(len(start), dtype=np.int64), np.ones(len(start), dtype=np.int64)
        places[known], counts[known] = self.store.place[row[known]], self.store.count[row[known]]
        ids, alone = self.store.ids, np.flatnonzero(~known & (stop > start))
        if len(alone):  # not remembered
            found = self.whole([blob[a:b] for a, b in zip(start[alone].tolist(), stop[alone].tolist())])
            counts[alone] = [len(f) for f in found]
            places[alone] = len(ids) + np.cumsum(counts[alone]) - counts[alone]
            ids = np.concatenate([ids, *found])
        return ids[gathered(places, counts)], np.cumsum(counts)

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of each text as bytes, the end id behind them."""
        if not self.by_piece:
            return pa.array([np.append(ids, np.array(self.end_id, self.kind)).tobytes()
                             for ids in self.whole([t.encode() for t in texts.to_pylist()])], pa.binary())
        if len(self.memo) > self.memo.room:
            self.store.keep(self.memo.shrink())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1, offset=4 * texts.offset).astype(np.int64)
        blob = texts.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if offsets[-1] > offsets[0] else b""
        offsets -= offsets[0]
        data = np.frombuffer(blob or b" ", dtype=np.uint8)
        white = SPACE[data[:len(blob)]]
        begins = white.copy()
        begins[1:] &= ~white[:-1]
        for t in np.unique(np.searchsorted(offsets, [m.start() for m in OTHER_SPACE.finditer(blob)], "right")):
            begins[offsets[t - 1]:offsets[t]] = False
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(begins)
        stop = np.append(start[1:], len(blob)) if len(start) else start
        bounds = np.searchsorted(start, offsets[1:])
        start, stop = np.insert(start, bounds, 0), np.insert(stop, bounds, 0)
        ids, ends, base = [], [], 0
        for i in range(0, len(start), WINDOW):
            part, upto = self.look_up(blob, data, start[i:i + WINDOW], stop[i:i + WINDOW])
            ids.append(part)
            ends.append(upto + base)
            base += len(part)
        close = np.concatenate(ends)[bounds + np.arange(len(texts))] if len(texts) else np.zeros(0, dtype=np.int64)
        held = np.concatenate(ids) if ids else np.zeros(0, dtype=self.kind)
        upto = (np.concatenate([[0], close]) * held.dtype.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(upto.tobytes()), pa.py_buffer(held.tobytes())])


_ENCODER: dict[tuple, PieceEncoder] = {}


def loaded(source: str, end_id: int, kind: str) -> PieceEncoder:
    """The encoder of this worker process; one at a time is kept."""
    key = (hash(source), end_id, kind)
    if key not in _ENCODER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODER.clear()
        _ENCODER[key] = PieceEncoder(source, end_id, kind)
    return _ENCODER[key]


def groups_of(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Neighbouring texts of at most ``size`` bytes in all, or one longer text."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts)))
    first = 0
    while first < len(texts):
        before = int(ends[first - 1]) if first else 0
        last = max(int(np.searchsorted(ends, before + size, "right")), first + 1)
        yield texts.slice(first, last - first)
        first = last


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, end_id: int, wide: bool) -> DataFrame:
    """id, row, ids (little endian, 16 bits each, 32 where the vocabulary needs them)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = "<u4" if wide else "<u2"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(source.value, end_id, kind)
        for batch in batches:
            done = [encoder.encode(texts) for texts in groups_of(batch.column("text"), ENCODE_BYTES)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.concat_arrays(done) if done else pa.array([], pa.binary())],
                ["id", "row", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                       whole(text_col).alias("text"))
    return rows.mapInArrow(encode, IDS)


def held_ids(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows of a binary column, and where each row's ids end."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32, count=len(column) + 1, offset=4 * column.offset).astype(np.int64)
    width = np.dtype(kind).itemsize
    data = column.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, dtype=kind), np.zeros(len(column), dtype=np.int64)
    ids = np.frombuffer(data, dtype=kind, count=int(ends[-1] - ends[0]) // width, offset=int(ends[0]))
    return ids, (ends[1:] - ends[0]) // width


def id_counts(tokens: DataFrame, n_ids: int, wide: bool) -> np.ndarray:
    """How often each id occurs.  Every task sends one row for each id that it
    met, and the driver gets at most one for each id of the vocabulary."""
    kind = "<u4" if wide else "<u2"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, dtype=np.int64)
        for batch in batches:
            ids, _ = held_ids(batch.column("ids"), kind)
            total += np.bincount(ids, minlength=n_ids)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["id", "n"])

    out = np.zeros(n_ids, dtype=np.int64)
    for r in tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def framed_rows(tokens: DataFrame, lengths: np.ndarray, wide: bool) -> DataFrame:
    """Frames of the sorted documents of each partition."""
    code = tokens.sparkSession.sparkContext.broadcast(lengths.astype(np.uint8))
    kind = "<u4" if wide else "<u2"
    schema = pa.schema([("shard", pa.int32()), ("seq", pa.int64()), ("first", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                        ("checkpoints", pa.binary()), ("bits", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = code.value.astype(np.int64)
        codes, _, _ = canonical(lengths)
        shard, seq, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, held, size = [], [], 0

        def frame() -> pa.RecordBatch:
            checkpoints, bits = pack(np.concatenate(held), codes, lengths)
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "seq": seq, "first": first, "doc_ids": doc_ids, "lengths": [len(h) for h in held],
                "checkpoints": checkpoints, "bits": bits}], schema=schema)

        for batch in batches:
            ids, ends = held_ids(batch.column("ids"), kind)
            for doc_id, own in zip(batch.column("id").to_pylist(), np.split(ids, ends[:-1])):
                doc_ids.append(doc_id)
                held.append(own.copy())
                size += len(held[-1])
                if size >= FRAME_IDS:
                    yield frame()
                    seq, first = seq + 1, first + size
                    doc_ids, held, size = [], [], 0
        if held:
            yield frame()

    ranged = tokens.repartitionByRange(F.asc_nulls_first("id"), F.asc("row"))
    return ranged.sortWithinPartitions(F.asc_nulls_first("id"), F.asc("row")).select("id", "ids").mapInArrow(write, FRAMES)


# --- files --------------------------------------------------------------------

def write_token_files(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = 0) -> str:
    """Write the token ids of all documents, ``end_id`` after each, and return the
    folder (a new one below ``spark.checkpoint.dir`` unless ``path`` names one).

    ``tokenizer_path``: a tokenizers .json, read by the driver and broadcast; it
    does not grow with the data.  Null and empty texts hold the end id alone.
    Null ids come first; rows of the same id, repeated ones too, are written in
    the order of the table.  A text of any length is one document of one frame.
    An empty table gives a code book and no frame.  Other columns are not read.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    bound_batches(spark)
    path = path or stage_path(spark, "token-files")
    n_ids = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1)
    wide = n_ids > 1 << 16
    held = stage_path(spark, "token-ids")
    tokenize(docs, tokenizer_path, id_col, text_col, end_id, wide).write.option("compression", "zstd").parquet(held)
    tokens = spark.read.schema(IDS).parquet(held)
    lengths = code_lengths(id_counts(tokens, n_ids, wide))
    book = spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, bits int")
    book.coalesce(1).write.parquet(f"{path}/codebook")
    framed_rows(tokens, lengths, wide).write.option("compression", "uncompressed").parquet(f"{path}/frames")
    return path


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document of the folder: id, start (ids of all documents before
    it), ids (binary, unsigned 32 bits each, little endian).

    Frames are decoded apart from each other; what a shard starts at is the sum
    of the shards before it, one number for each.
    """
    bound_batches(spark)
    rows = spark.read.schema("id int, bits int").parquet(f"{path}/codebook").collect()  # at most one for each id
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, dtype=np.int64)
    for r in rows:
        lengths[r["id"]] = r["bits"]
    code = spark.sparkContext.broadcast(lengths.astype(np.uint8))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(code.value.astype(np.int64))
        for batch in batches:
            sizes = batch.column("lengths").to_pylist()
            frames = [(sum(n), c, b) for n, c, b in zip(sizes, batch.column("checkpoints").to_pylist(),
                                                        batch.column("bits").to_pylist())]
            doc_ids, starts, out = [], [], []
            for own, n, first, ids in zip(batch.column("doc_ids").to_pylist(), sizes,
                                          batch.column("first").to_pylist(), decoder.unpack(frames)):
                ends = np.cumsum(n)
                doc_ids += own
                starts += (ends - n + first).tolist()
                out += [ids[e - m:e].astype("<u4").tobytes() for e, m in zip(ends.tolist(), n)]
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()),
                                              pa.array(out, pa.binary())], ["id", "start", "ids"])

    frames = spark.read.schema(FRAMES).parquet(f"{path}/frames")
    held = frames.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = frames.join(F.broadcast(bases), "shard").withColumn("first", F.col("first") + F.col("base"))
    return (placed.select("first", "doc_ids", "lengths", "checkpoints", "bits")
            .mapInArrow(decode, "id long, start long, ids binary").withColumnRenamed("id", id_col))
