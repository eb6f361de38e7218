"""Token counts by a compiled finite-state tokenizer.

The byte-level BPE vocabulary is compiled into a deterministic transducer that
reads bytes from left to right.  Its state is the longest end of what it has
read that begins a token; the tokens that end there are listed with the state.
The encoding of what was read ends in the one of them whose left neighbour, the
last token where it begins, may stand before it (two tokens may be neighbours if
their joined bytes encode to just these two).  The transition emits that token
and annotates the count, so a word is counted without replaying merges, in time
linear in its length.  Transitions are determined when first needed.  The path of a whole word is
kept as one annotated transition and further words cost one lookup.

Texts are cut into chunks at any code point.  What a chunk does is a state map:
the text before its first word start (to be joined with what came before), the
tokens counted in between, and the text from its last word start on.  Maps
compose associatively, so a document's chunks are counted wherever they are and
combined by a prefix scan in chunk order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneldeck.llm.text import bound_batches, whole
from paneldeck.session import write_stage

# The pre-tokenizer's pattern (public GPT-2 rule) and Unicode White_Space.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|["
         + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
# No word goes on from other characters to white space, whatever surrounds them.
WORD_START = "(?<=[^" + SPACE + "])(?=[" + SPACE + "])"
FIRST_START, LAST_START = regex.compile(WORD_START), regex.compile("(?r)" + WORD_START)


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary: printable
    Latin-1 stands for itself, the rest follows from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class CountTransducer(dict):
    """Word -> emitted tokens, for the words read so far; others are run through
    the automaton.  ``room`` bounds the remembered words and pairs (beyond it
    they are forgotten and found again: results don't change)."""

    def __init__(self, tokenizer_json: str, room: int = 1 << 19):
        super().__init__()
        spec = json.loads(tokenizer_json)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        letters = byte_letters()
        self.byte_of = {c: b for b, c in letters.items()}
        raw = lambda t: bytes(self.byte_of[c] for c in t)
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        self.tokens = [b"", *sorted({bytes([b]) for b in range(256)} | {a + b for a, b in self.rank})]
        self.number = {t: i for i, t in enumerate(self.tokens)}
        self.prefixes = {t[:i] for t in self.tokens for i in range(len(t) + 1)}
        # states: the longest end of what was read that begins a token
        self.states, self.state_of, self.next, self.ends = [], {}, [], []
        self.state(b"")
        self.pairs: dict[int, bool] = {}
        self.room = room
        self.split = regex.compile(SPLIT).findall
        special = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        if any(FIRST_START.search(t["content"]) for t in spec["added_tokens"]):
            raise ValueError("a special string spans words")
        self.special = regex.compile("|".join(special)) if special else None

    def merged(self, text: bytes) -> list[bytes]:
        """Encoding by repeated merges; used on the bytes of two tokens only."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def state(self, read: bytes) -> int:
        """Number of a state; (token, length) of the tokens that end there are
        listed with it, longest first."""
        if read not in self.state_of:
            self.state_of[read] = len(self.states)
            self.states.append(read)
            self.next.append({})
            self.ends.append([(self.number[read[i:]], len(read) - i) for i in range(len(read))
                              if read[i:] in self.number])
        return self.state_of[read]

    def step(self, state: int, byte: int) -> int:
        """The transition of a state on a byte, determined when first needed."""
        read = self.states[state] + bytes([byte])
        while read not in self.prefixes:
            read = read[1:]
        self.next[state][byte] = found = self.state(read)
        return found

    def may_follow(self, left: int, right: int) -> bool:
        """Whether two tokens can be neighbours; left 0: whether right begins a word."""
        if len(self.pairs) >= self.room:
            self.pairs.clear()
        a, b = self.tokens[left], self.tokens[right]
        found = self.pairs[left << 32 | right] = self.merged(a + b) == ([a, b] if a else [b])
        return found

    def run(self, text: bytes) -> int:
        """Tokens that the automaton has emitted at the end of one word."""
        last, count, state = [0], [0], 0
        following, pairs, ends = self.next, self.pairs, self.ends
        for at, byte in enumerate(text, 1):
            on = following[state].get(byte)
            state = self.step(state, byte) if on is None else on
            for token, length in ends[state]:
                left = last[at - length]
                fits = pairs.get(left << 32 | token)
                if self.may_follow(left, token) if fits is None else fits:
                    last.append(token)
                    count.append(count[at - length] + 1)
                    break
        return count[-1]

    def __missing__(self, word: str) -> int:
        if len(self) >= self.room:
            self.clear()
        count = self.run(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 64:
            self[word] = count
        return count

    def count(self, text: str) -> int:
        """Tokens of a text; special strings count one."""
        if self.special is None:
            return sum(map(self.__getitem__, self.split(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.split(part))) for part in parts)

    def state_map(self, chunk: str) -> tuple[bool, str, int, str]:
        """(cut, head, tokens, tail).  Without a word start, all is head."""
        first, last = FIRST_START.search(chunk), LAST_START.search(chunk)
        if first is None:
            return False, chunk, 0, ""
        return True, chunk[:first.start()], self.count(chunk[first.start():last.start()]), chunk[last.start():]

    def compose(self, left: tuple, right: tuple) -> tuple[bool, str, int, str]:
        """The state map of two neighbouring chunks."""
        cut_left, head_left, n_left, tail_left = left
        cut_right, head_right, n_right, tail_right = right
        if cut_left and cut_right:
            return True, head_left, n_left + self.count(tail_left + head_right) + n_right, tail_right
        if cut_left:
            return True, head_left, n_left, tail_left + head_right
        return cut_right, head_left + head_right, n_right, tail_right

    def total(self, whole_map: tuple) -> int:
        """Tokens of a text from its state map."""
        _, head, n, tail = whole_map
        return self.count(head) + n + self.count(tail)

    def scan(self, maps: list[tuple]) -> tuple:
        """All maps in order as one, by pairs of neighbours."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]


_COMPILED: dict[int, CountTransducer] = {}


def compiled(tokenizer_json: str) -> CountTransducer:
    """One transducer for each tokenizer and worker process."""
    key = hash(tokenizer_json)
    if key not in _COMPILED:
        _COMPILED[key] = CountTransducer(tokenizer_json)
    return _COMPILED[key]


MAPS = "row long, id long, n_bytes long, n_chunks int, no int, cut boolean, head string, tokens long, tail string"


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, chunk_chars: int = 16_384) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit.

    ``tokenizer_path``: a byte-level BPE file (tokenizers .json), read by the
    driver; the vocabulary, a few MB that don't grow with the data, is broadcast.

    Null text: 0 bytes, 0 tokens.  Repeated rows and null ids: one result row for
    each row.  Texts of any length are counted whole, chunk by chunk.  An empty
    table gives an empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())

    def map_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = compiled(vocabulary.value)
        for batch in batches:
            maps = [(False, "", machine.count(c), "") if n == 1 else machine.state_map(c)
                    for c, n in zip(batch.pop("chunk"), batch["n_chunks"])]
            yield batch.assign(**{c: [m[i] for m in maps] for i, c in enumerate(("cut", "head", "tokens", "tail"))})

    def join_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = compiled(vocabulary.value)
        for batch in batches:
            totals = [machine.total(machine.scan([(m["cut"], m["head"], m["tokens"], m["tail"]) for m in maps]))
                      for maps in batch.pop("maps")]
            yield batch.assign(n_tokens=totals)

    size = F.lit(chunk_chars)
    chunks = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                          whole(text_col).alias("text"))
              .select("row", "id", F.octet_length("text").cast("long").alias("n_bytes"), "text",
                      F.greatest(F.lit(1), F.ceil(F.length("text") / size)).cast("int").alias("n_chunks"))
              .select("row", "id", "n_bytes", "n_chunks", "text",
                      F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("no"))
              .select("row", "id", "n_bytes", "n_chunks", "no",
                      F.when(F.col("n_chunks") == 1, F.col("text"))
                      .otherwise(F.substring("text", F.col("no") * size + 1, size)).alias("chunk")))
    maps = write_stage(chunks.mapInPandas(map_chunks, MAPS), "token-maps")
    one = maps.where("n_chunks = 1").select("id", "n_bytes", F.col("tokens").alias("n_tokens"))
    more = (maps.where("n_chunks > 1").groupBy("row", "id", "n_bytes")
            .agg(F.sort_array(F.collect_list(F.struct("no", "cut", "head", "tokens", "tail"))).alias("maps"))
            .select("id", "n_bytes", "maps").mapInPandas(join_chunks, "id long, n_bytes long, n_tokens long"))
    return one.unionByName(more).select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                                        (F.col("n_tokens") > limit).alias("over_limit"))
