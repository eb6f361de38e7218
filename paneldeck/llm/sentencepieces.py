"""SentencePiece encoding and decoding with exact N-best segmentations.

A text's piece lattice falls apart wherever no piece spans two characters, so it
is a chain of segments (about one to a word).  In a segment a forward Viterbi pass
gives the best score up to each position and a backward pass the best score after
it; the two together give the best and how much the second best loses.  Further
segmentations come from an A-star search that runs backwards over the lattice with
the forward scores as its heuristic, which is exact, so paths leave the queue in
the order of their scores.

The N best of a whole text can differ from its best only in the N - 1 segments
that lose least; only those are searched, and their lists are merged.

The public model file is a byte-pair model: its scores are merge ranks, not log
probabilities.  By default a piece gets the log probability that Zipf's law gives
its rank (byte pieces come last); ``scores="model"`` uses the file's own numbers.
Text is read as the file's own normaliser does (spaces as U+2581, one put before);
characters without a piece, and U+2581 itself, become byte pieces, so every text
comes back from its pieces unchanged.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain, count
from math import fsum, inf, log

import numpy as np
import pandas as pd
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneldeck.llm.memo import ByteMemo, IdStore, gathered
from paneldeck.llm.text import bound_batches, fresh, give_back, whole

SPACE = "▁"
LITERAL = "\0" + SPACE  # a segment of its own: U+2581 as it stands in a text
BATCH = "2m"  # texts that a worker holds at once; with all that is made of them it takes about 60 times as much


def spread(x: np.ndarray, salt: int) -> np.ndarray:
    """64 mixed bits of each value."""
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class PieceIndex:
    """Pieces found by two polynomial hashes of their characters, 128 bits in all,
    for many stretches of text at once."""

    BASES = (np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5))

    def __init__(self, pieces: dict[str, tuple[float, tuple[int, ...]]]):
        self.longest = max(map(len, pieces))
        self.powers = [np.cumprod(np.full(self.longest, b, dtype=np.uint64)) for b in self.BASES]
        names, values = list(pieces), list(pieces.values())
        size, found = np.array([len(p) for p in names]), np.empty((len(names), 2), dtype=np.uint64)
        for n in np.unique(size):
            same = np.flatnonzero(size == n)
            codes = "".join(names[k] for k in same).encode("utf-32-le", "surrogatepass")
            found[same] = np.stack([s[:, -1] for s in self.prefixes(np.frombuffer(codes, "<u4").reshape(-1, n))], axis=1)
        order = np.argsort(found[:, 0])
        self.first, self.second = found[order, 0], found[order, 1]
        self.score = np.array([values[k][0] for k in order])
        self.id = np.array([values[k][1][0] for k in order], dtype=np.int64)
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[self.first >> np.uint64(44)] = True

    def prefixes(self, codes: np.ndarray) -> list[np.ndarray]:
        """Both hashes of all beginnings of each row, the empty one first."""
        out = []
        for salt, base in enumerate(self.BASES):
            value, sums = spread(codes, salt + 1), np.zeros((len(codes), codes.shape[1] + 1), dtype=np.uint64)
            for i in range(codes.shape[1]):
                sums[:, i + 1] = sums[:, i] * base + value[:, i]
            out.append(sums)
        return out

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) by row, start and length - 1 of the pieces in each row; no
        piece has the score -inf and the id -1."""
        rows, n = codes.shape
        top = min(n, self.longest)
        scores, ids = np.full((rows, n, top), -np.inf), np.full((rows, n, top), -1, dtype=np.int64)
        one, two = self.prefixes(codes)
        for length in range(1, top + 1):
            first = one[:, length:] - one[:, :n + 1 - length] * self.powers[0][length - 1]
            row, start = np.nonzero(self.seen[first >> np.uint64(44)])
            first = first[row, start]
            at = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
            same = self.first[at] == first
            row, start, at = row[same], start[same], at[same]
            same = two[row, start + length] - two[row, start] * self.powers[1][length - 1] == self.second[at]
            row, start, at = row[same], start[same], at[same]
            scores[row, start, length - 1], ids[row, start, length - 1] = self.score[at], self.id[at]
        return scores, ids


class Lattice(dict):
    """Segment -> (ids of the best segmentation, its score, loss of the second
    best), for odd texts; at most an eighth of ``room`` are kept.  Texts are encoded
    many at once by a memo of about ``room`` segments, some 60 bytes each."""

    def __init__(self, model: bytes, scores: str = "zipf", room: int = 1 << 18):
        super().__init__()
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.surface = [sp.id_to_piece(i) for i in range(size)]
        self.byte_of = {i: int(self.surface[i][3:5], 16) for i in range(size) if sp.is_byte(i)}
        normal = [i for i in range(size)
                  if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        ranked = sorted(normal, key=lambda i: (-sp.get_score(i), i))
        total = log(fsum(1 / (r + 1) for r in range(len(ranked) + 1)))
        zipf = {i: -log(r + 1) - total for r, i in enumerate(ranked)}
        value = zipf.__getitem__ if scores == "zipf" else sp.get_score
        self.pieces = {self.surface[i]: (value(i), (i,)) for i in normal}
        self.trie: dict = {}  # character -> [nodes that follow, (score, ids) of the piece that ends there or None]
        for piece, found in self.pieces.items():
            following = self.trie
            for c in piece:
                node = following.setdefault(c, [{}, None])
                following = node[0]
            node[1] = found
        self.index = PieceIndex(self.pieces)
        self.byte_score = min(v for v, _ in self.pieces.values()) - 1.0
        self.byte_ids = {b: i for i, b in self.byte_of.items()}
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no byte pieces")
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece spans words")
        self.spoken = [chr(self.byte_of[i]) if i in self.byte_of else s.replace(SPACE, " ")
                       for i, s in enumerate(self.surface)]
        self.high = np.array([self.byte_of.get(i, 0) >= 128 for i in range(size)])
        # no piece joins a letter to anything but letters and the space before them
        inner = {c for p in self.pieces if len(p) > 1 for c in p} - {SPACE}
        if any(a.isalpha() != b.isalpha() for p in self.pieces for a, b in zip(p.lstrip(SPACE), p.lstrip(SPACE)[1:])):
            raise ValueError("a piece joins letters and other characters")
        letters, others = (re.escape("".join(sorted(c for c in inner if c.isalpha() == x))) for x in (True, False))
        self.segments = re.compile(f"{SPACE}+(?:[{letters}]+|[{others}]+)?|[{letters}]+|[{others}]+|"
                                      f"[^{letters}{others}{SPACE}]").findall
        self.room = room
        self.memo, self.store = ByteMemo(room), IdStore(np.zeros(0, dtype=np.int32))
        self.score, self.loss = np.zeros(0), np.zeros(0)
        # the kind of each character: space, letter or other of some piece, none
        self.kind = np.full(0x110000, 3, dtype=np.uint8)
        for c in inner:
            self.kind[ord(c)] = 1 if c.isalpha() else 2
        self.kind[ord(" ")] = 0
        self.searched: dict[tuple[str, int], list] = {}
        self.prefix = SPACE if sp.encode("a", out_type=str)[0].startswith(SPACE) else ""

    def forward(self, segment: str) -> tuple[list, list[float], list]:
        """(edges, best, via): for each position the (end, score, ids) of the pieces
        that start there, the best score up to it and where the edge that
        reaches it starts."""
        n, trie = len(segment), self.trie
        edges, best, via = [], [0.0] + [-inf] * n, [0] * (n + 1)
        for start in range(n):
            here, following, upto = [], trie, best[start]
            for end in range(start, n):
                node = following.get(segment[end])
                if node is None:
                    break
                following, found = node
                if found:
                    score, ids = found
                    here.append((end + 1, score, ids))
                    score += upto
                    if score > best[end + 1]:
                        best[end + 1], via[end + 1] = score, start
            if not here or here[0][0] > start + 1:
                raw = segment[start].encode("utf-8", "surrogatepass")
                score, ids = self.byte_score * len(raw), tuple(self.byte_ids[b] for b in raw)
                here.append((start + 1, score, ids))
                if upto + score > best[start + 1]:
                    best[start + 1], via[start + 1] = upto + score, start
            edges.append(here)
        return edges, best, via

    def __missing__(self, segment: str) -> tuple[tuple[int, ...], float, float]:
        if segment == LITERAL:
            ids = tuple(self.byte_ids[b] for b in SPACE.encode())
            return ids, self.byte_score * len(ids), inf
        edges, best, via = self.forward(segment)
        n = len(edges)
        on_path, at = [0] * n, n
        while at:
            on_path[via[at]] = at
            at = via[at]
        # the best path over an edge scores best up to it + the edge + best after it
        after, second, path = [0.0] * (n + 1), -inf, []
        for start in range(n - 1, -1, -1):
            top, there, upto = -inf, on_path[start], best[start]
            for end, score, ids in edges[start]:
                score += after[end]
                if score > top:
                    top = score
                if end == there:
                    path.append(ids)
                elif upto + score > second:
                    second = upto + score
            after[start] = top
        found = tuple(chain.from_iterable(reversed(path))), best[n], max(0.0, best[n] - second)
        if len(self) >= self.room >> 3:
            self.clear()
        if n <= 64:
            self[segment] = found
        return found

    def learn(self, segments: list[str]) -> None:
        """Both passes for many new segments, those of one length together; their
        values become the next rows of the memo."""
        size = np.array([len(g) for g in segments])
        score, loss, found = np.empty(len(size)), np.empty(len(size)), [()] * len(size)
        for n in np.unique(size).tolist():
            same = np.flatnonzero(size == n)
            for own in np.array_split(same, 1 + len(same) * n * n // 400_000):
                score[own], loss[own], ids = self.passes([segments[i] for i in own.tolist()], n)
                for i, path in zip(own.tolist(), ids):
                    found[i] = path
        self.score, self.loss = np.concatenate([self.score, score]), np.concatenate([self.loss, loss])
        count = np.array([len(f) for f in found])
        self.store.add(np.fromiter(chain.from_iterable(found), dtype=np.int32, count=count.sum()), count)

    def passes(self, segments: list[str], n: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """(scores, losses, ids of the best) of segments of n characters."""
        rows = len(segments)
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "<u4").reshape(rows, n)
        scores, ids = self.index.edges(codes)
        top = scores.shape[2]
        raw = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        scores[:, :, 0] = np.where(ids[:, :, 0] < 0, self.byte_score * raw, scores[:, :, 0])
        best, via = np.zeros((rows, n + 1)), np.zeros((rows, n + 1), dtype=np.int64)
        for end in range(1, n + 1):
            start = np.arange(max(0, end - top), end)  # of equal paths the one with the earliest start
            reached = best[:, start] + scores[:, start, end - start - 1]
            via[:, end] = start[reached.argmax(axis=1)]
            best[:, end] = reached.max(axis=1)
        on_path, every = np.zeros((rows, n), dtype=np.int64), np.arange(rows)
        at, left = np.full(rows, n), every
        while len(left):
            before = via[left, at[left]]
            on_path[left, before] = at[left]
            at[left] = before
            left = left[before > 0]
        after, second = np.zeros((rows, n + 1)), np.full(rows, -np.inf)
        for start in range(n - 1, -1, -1):
            end = np.arange(start + 1, min(n, start + top) + 1)
            onward = scores[:, start, :len(end)] + after[:, end]
            after[:, start] = onward.max(axis=1)
            other = np.where(on_path[:, start, None] == end, -np.inf, best[:, start, None] + onward)
            second = np.maximum(second, other.max(axis=1))
        row, start = np.nonzero(on_path)
        found = ids[row, start, on_path[row, start] - start - 1].tolist()
        upto = np.searchsorted(row, every, "right").tolist()
        starts, first, paths = start.tolist(), 0, []
        for segment, last in zip(segments, upto):
            path = found[first:last]
            if -1 in path:
                path = [i for k, p in enumerate(path) for i in (
                    (p,) if p >= 0 else (self.byte_ids[b] for b in segment[starts[first + k]].encode("utf-8", "surrogatepass")))]
            paths.append(path)
            first = last
        return best[:, n], np.maximum(0.0, best[:, n] - second), paths

    def n_best(self, segment: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best (score, ids) of a segment, best first; remembered like the
        best ones, in an eighth of their room."""
        found = self.searched.get((segment, n))
        if found is None:
            if len(self.searched) >= self.room >> 3:
                self.searched.clear()
            found = self._search(segment, n)
            if len(segment) <= 64:
                self.searched[segment, n] = found
        return found

    def _search(self, segment: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        edges, best, _ = self.forward(segment)
        into: list[list] = [[] for _ in range(len(edges) + 1)]
        for start, here in enumerate(edges):
            for end, score, ids in here:
                into[end].append((start, score, ids))
        order, found = count(), []
        queue = [(-best[-1], next(order), len(edges), 0.0, None)]
        while queue and len(found) < n:
            _, _, at, score, path = heapq.heappop(queue)
            if at == 0:
                ids = []
                while path:
                    ids.extend(path[0])
                    path = path[1]
                found.append((score, tuple(ids)))
            for start, edge, ids in into[at]:
                heapq.heappush(queue, (-(best[start] + edge + score), next(order), start, edge + score, (ids, path)))
        return found

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        first, *rest = text.split(SPACE)
        found = self.segments(self.prefix + first.replace(" ", SPACE))
        for part in rest:
            found.append(LITERAL)
            found += self.segments(part.replace(" ", SPACE))
        return found

    def encode(self, text: str, n: int) -> tuple[np.ndarray, list[float], list[list[tuple[int, int, tuple[int, ...]]]]]:
        """(ids, scores, changes): the best segmentation, the scores of the n best,
        and for each of these the stretches (from, to) of the best's ids that it
        replaces, in their order, with its own ids there."""
        segments = self.split(text)
        parts = list(map(self.__getitem__, segments))
        if not parts:
            return np.empty(0, dtype=np.int32), [0.0], [[]]
        pieces, values, losses = zip(*parts)
        ids = np.fromiter(chain.from_iterable(pieces), dtype=np.int32)
        picks = [(at, segments[at], pieces[at], values[at])
                 for loss, at in heapq.nsmallest(n - 1, zip(losses, count())) if loss < inf]
        starts = np.cumsum([0, *map(len, pieces)])
        return ids, *self.merged(fsum(values), picks, starts, n)

    def merged(self, score: float, picks: list[tuple], starts: np.ndarray, n: int) -> tuple:
        """(scores, changes) of the n best, from the segments that lose least: their
        number, text, best ids and score; ``starts``: where each segment's ids start."""
        combined = [(0.0, ())]
        for at, segment, best, value in picks:
            others = [(max(0.0, value - s), i) for s, i in self.n_best(segment, n) if i != best][:n - 1]
            combined = heapq.nsmallest(n, [(lost, how) for lost, how in combined] + [
                (lost + more, (*how, (at, i))) for lost, how in combined for more, i in others])
        return [score - lost for lost, _ in combined], [
            [(int(starts[at]), int(starts[at + 1]), i) for at, i in sorted(how)] for _, how in combined]

    def encode_all(self, texts: Iterable[str], n: int) -> Iterator[tuple]:
        """``encode`` of many texts, some million characters at once."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= 500_000:
                yield from self._encode_together(held, n)
                held, size = [], 0
        yield from self._encode_together(held, n)

    def _encode_together(self, texts: list[str], n: int) -> Iterator[tuple]:
        plain = [t for t in texts if t and SPACE not in t]
        if len(self.memo) > self.room:
            stay = self.memo.shrink()
            self.store.keep(stay)
            self.score, self.loss = self.score[stay], self.loss[stay]
        lead = self.prefix.replace(SPACE, " ")
        joined = "".join(lead + t for t in plain)
        first = np.cumsum([0, *(len(lead) + len(t) for t in plain)])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass") or b" ", np.uint8)
        kind = self.kind[codes]
        begins = np.ones(len(codes), dtype=bool)
        begins[1:] = (kind[1:] == 3) | (kind[1:] != kind[:-1]) & ~((kind[:-1] == 0) & (kind[1:] != 3))
        begins[first[:-1]] = True
        start = np.flatnonzero(begins)
        stop = np.append(start[1:], len(codes)) if len(start) else start
        at_byte = np.concatenate([[0], np.cumsum(1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF))])

        def segment(i: int) -> str:
            return joined[start[i]:stop[i]].replace(" ", SPACE)

        def learn(new: np.ndarray) -> np.ndarray:
            self.learn([segment(i) for i in new])
            return np.ones(len(new), dtype=bool)

        row = self.memo.rows(data, at_byte[start], at_byte[stop], learn)
        alone = np.flatnonzero(row < 0)
        found = [self[segment(i)] for i in alone]
        place, counts = np.zeros(len(row), dtype=np.int64), np.zeros(len(row), dtype=np.int64)
        score, loss = np.zeros(len(row)), np.zeros(len(row))
        known = row >= 0
        place[known], counts[known] = self.store.place[row[known]], self.store.count[row[known]]
        score[known], loss[known] = self.score[row[known]], self.loss[row[known]]
        counts[alone] = [len(f[0]) for f in found]
        score[alone], loss[alone] = [f[1] for f in found], [f[2] for f in found]
        place[alone] = len(self.store.ids) + np.cumsum(counts[alone]) - counts[alone]
        ids = np.concatenate([self.store.ids, *(np.array(f[0], dtype=np.int32) for f in found)])[gathered(place, counts)]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ends = np.searchsorted(start, first)
        place_of = iter(range(len(plain)))
        for text in texts:
            if not text or SPACE in text:
                yield self.encode(text, n)
                continue
            k = next(place_of)
            low, high = ends[k], ends[k + 1]
            own = loss[low:high]
            picks = []
            for at in np.argsort(own, kind="stable")[:n - 1] if n > 1 else ():
                if own[at] < inf:
                    i = low + at
                    picks.append((int(at), segment(i), tuple(ids[upto[i]:upto[i + 1]].tolist()), float(score[i])))
            yield ids[upto[low]:upto[high]], *self.merged(fsum(score[low:high].tolist()), picks, upto[low:high + 1] - upto[low], n)

    def changed(self, ids: np.ndarray, changes: list[tuple[int, int, tuple[int, ...]]]) -> np.ndarray:
        """The ids of another segmentation, from the best's and what it replaces."""
        parts, at = [], 0
        for start, end, other in changes:
            parts += [ids[at:start], np.array(other, dtype=np.int32)]
            at = end
        return np.concatenate([*parts, ids[at:]])

    def digest(self, ids: np.ndarray, changes: list[list[tuple[int, int, tuple[int, ...]]]]) -> int:
        """64 bits of the lengths and ids of all segmentations, best first."""
        state = xxhash.xxh3_64()
        for how in changes:
            other = self.changed(ids, how) if how else ids
            state.update(len(other).to_bytes(8, "little"))
            state.update(other.astype("<i4", copy=False))
        return state.intdigest() - (1 << 63)

    def n_best_ids(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a text in full."""
        ids, scores, changes = self.encode(text, n)
        return [(score, self.changed(ids, how).tolist()) for score, how in zip(scores, changes)]

    def decode(self, ids) -> str:
        """The text of a segmentation."""
        if not self.high[ids].any():
            out = map(self.spoken.__getitem__, ids)
        else:
            out, raw = [], bytearray()
            for i in [*ids, 0]:
                if i in self.byte_of:
                    raw.append(self.byte_of[i])
                    continue
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
                out.append(self.spoken[i])
            out.pop()  # the 0 that ends the last run of bytes
        text = "".join(out)
        return text[1:] if self.prefix and text.startswith(" ") else text


_COMPILED: dict[tuple[int, str], Lattice] = {}


def compiled(model: bytes, scores: str) -> Lattice:
    """One lattice for each model and worker process."""
    key = hash(model), scores
    if key not in _COMPILED:
        _COMPILED[key] = Lattice(model, scores)
    return _COMPILED[key]


def _broadcast(spark: SparkSession, model_path: str):
    """The model file, read by the driver: under 1 MB whatever the corpus."""
    with open(model_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model_path: str, text_col: str = "text", n_best: int = 4, scores: str = "zipf",
           full: bool = False, check: bool = False, digest: bool = False) -> DataFrame:
    """``docs`` plus ids (the best segmentation), scores (log probabilities of the
    ``n_best`` best, fewer if there are fewer), if ``full``, n_best_ids (all of them,
    best first), if ``digest``, n_best_hash (64 bits of all of them, made where they
    are found) and, if ``check``, round_trip (whether the text was decoded from its
    ids unchanged).

    Null text reads as empty: no ids, one segmentation of score 0.  Texts of any
    length are encoded whole.  Repeated rows are encoded like any.  An empty table
    gives an empty result.  Columns of ``docs`` with these names are replaced.
    """
    bound_batches(docs.sparkSession, BATCH)
    model = _broadcast(docs.sparkSession, model_path)
    kind = ("ids array<int>, scores array<double>" + ", n_best_ids array<array<int>>" * full + ", n_best_hash long" * digest
            + ", round_trip boolean" * check)

    @F.pandas_udf(kind)
    def segment(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        give_back()  # what earlier stages left in this worker
        lattice = compiled(model.value, scores)
        for batch in texts:
            made = list(lattice.encode_all(batch, n_best))
            out = pd.DataFrame({"ids": [m[0] for m in made], "scores": [m[1] for m in made]})
            if full:
                out["n_best_ids"] = [[lattice.changed(ids, how) for how in changes] for ids, _, changes in made]
            if digest:
                out["n_best_hash"] = [lattice.digest(ids, changes) for ids, _, changes in made]
            if check:
                out["round_trip"] = [lattice.decode(m[0].tolist()) == text for m, text in zip(made, batch)]
            yield out
            del made, out, batch
            give_back()

    added = ["ids", "scores"] + ["n_best_ids"] * full + ["n_best_hash"] * digest + ["round_trip"] * check
    rest = docs.drop(*added)
    name, = fresh(rest, "_segmented")
    return rest.withColumn(name, segment(whole(text_col))).select(
        *rest.columns, *[F.col(f"{name}.{c}").alias(c) for c in added])


def decode(ids: Column, model_path: str, spark: SparkSession) -> Column:
    """The text of a column of ids (array<int>); null ids give an empty text."""
    model = _broadcast(spark, model_path)

    @F.pandas_udf("string")
    def text_of(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lattice = compiled(model.value, "zipf")
        for batch in rows:
            yield pd.Series([lattice.decode(x.tolist()) for x in batch])

    return text_of(F.coalesce(ids, F.array().cast("array<int>")))
