"""Structure repair, Merkle manifest and token files against brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from paneldeck.llm import repair, token_files
from paneldeck.llm.merkle import fold, height, local_paths, manifest_proofs, regrown
from paneldeck.llm.queries import damaged
from paneldeck.llm.repair import repair_conversations

BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- structure repair -----------------------------------------------------------

def brute_repair(rows):
    """(cost, audit, repaired lines) by plain dynamic programming over suffixes."""
    turn_key = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest())
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=turn_key)
    white = " \t\n\x0b\x0c\r"
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(white)
        faults.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
        seen.add((role, text))
    nxt = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
    kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    end = {0: (0, "", ()), 1: (6, "II", ("user:", "assistant:")), 2: (3, "I", ("assistant:",)), 3: (0, "", ())}
    for (_, role, text), fault in reversed(list(zip(rows, faults))):
        eat = {}
        for q in range(4):
            found = [(4 + end[q][0], "D" + end[q][1], end[q][2])]
            if fault not in (1, 2):
                more = 3 if fault == 3 else 0
                if (q, role[:1]) in kept:
                    c, a, o = end[kept[q, role[:1]]]
                    found.append((more + c, "K" + a, (f"{role}:{text}", *o)))
                c, a, o = end[nxt[q][0]]
                found.append((3 + more + c, "R" + a, (f"{nxt[q][1]}:{text}", *o)))
            eat[q] = min(found)
        for _ in range(2):
            eat = {q: min(eat[q], (3 + eat[nxt[q][0]][0], "I" + eat[nxt[q][0]][1], (f"{nxt[q][1]}:", *eat[nxt[q][0]][2])))
                   for q in range(4)}
        end = eat
    cost, audit, out = end[0]
    initials = [r[:1] for _, r, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def random_rows(rng, n):
    texts = ["Fine.", "Good!", "cut off", "", " \t", "Why?", None, "so. ", *(f"No {i}." for i in range(n))]
    return [(rng.choice([None, *range(2 * n)]), rng.choice(["system", "user", "assistant", "assistant", "user", "tool", "", None]),
             rng.choice(texts)) for _ in range(n)]


def compared(spark, rows):
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: tuple(r)[1:] for r in repair_conversations(conv).collect()}
    by = {}
    for c, *rest in rows:
        by.setdefault(c, []).append(tuple(rest))
    assert out.keys() == by.keys()
    for c in by:
        assert out[c] == brute_repair(by[c]), c


def test_repair_equals_brute_force(spark):
    rng = random.Random(5)
    compared(spark, [(c, *r) for c in [None, *range(120)] for r in random_rows(rng, rng.randint(1, 12))])


def test_repair_of_a_conversation_over_many_segments(spark, monkeypatch):
    """One conversation holds most rows: segments of 4 rows, runs of 4 segments, and small passes."""
    monkeypatch.setattr(repair, "SEGMENT_BITS", 2)
    monkeypatch.setattr(repair, "FAN_BITS", 2)
    rng = random.Random(6)
    compared(spark, [(7, *r) for r in random_rows(rng, 300)] + [(c, *r) for c in range(6) for r in random_rows(rng, 5)])


def test_repair_in_small_passes():
    rng = random.Random(7)
    codes = ["".join(rng.choice(repair.CODES) for _ in range(rng.randint(1, 30))) for _ in range(40)]
    whole = {i: (p[k, p.shape[1] - n[k]:].tolist(), int(n[k])) for own, p, n in repair.blocks(codes) for k, i in enumerate(own)}
    assert sorted(whole) == list(range(40))
    assert all("".join(repair.CODES[c] for c in row) == codes[i] and n == len(codes[i]) for i, (row, n) in whole.items())


def test_ranks_order_nodes_by_their_audits():
    rng = np.random.default_rng(3)
    n = 200
    pointer = np.minimum(np.arange(n) + rng.integers(1, 4, n), n - 1)
    letter = rng.choice(repair.LETTERS, n).astype(np.uint8)
    letter[-1] = 0
    audits = []
    for v in range(n):
        text = b""
        while v != n - 1:
            text, v = text + letter[v:v + 1].tobytes(), pointer[v]
        audits.append(text)
    ranks, _ = repair.ranked(letter, pointer, n)
    order = {a: i for i, a in enumerate(sorted(set(audits)))}
    assert [order[a] for a in audits] == ranks.tolist()


def test_repair_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    conv = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "long " * 200_000 + "."), (2, None, None, None)],
                                 schema).withColumns({c: F.lit("mine") for c in ("conv", "j", "n", "audit", "sig", "kind", "cost")})
    out = {r.conv_id: r for r in repair_conversations(conv, spark.createDataFrame([(9,), (None,)], "conv_id long")).collect()}
    assert out[1].audit == "KK" and out[1].cost == 0 and out[2].blank == 1 and out[2].audit == "D"
    for c in (9, None):
        assert tuple(out[c])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair_conversations(conv.limit(0)).count() == 0


def test_damage_by_hash(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    out = damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    by = {}
    for r in out.collect():
        by.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        want = {0: [], 1: [(role, "")], 2: [(role, text.replace(".", "").replace("!", ""))], 3: [(role, text)] * 2,
                4: [("user", text)]}.get(code, [(role, text)])
        assert by.get((c, t), []) == want


# --- Merkle manifest --------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    """(id, leaf) -> (subroot, root, joined siblings) from whole trees."""
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def proofs(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, a in enumerate(at):
                start = a // 3 * 3
                paths[i] += [n for k, n in enumerate(nodes[start:start + 3], start) if k != a]
            at = [a // 3 for a in at]
            nodes = [sha("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
        return nodes[0], paths

    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in order:
        own = sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[s] = (own, *proofs([leaf(r) for r in own]))
    root, tops = proofs([subs[s][1] for s in order])
    out = []
    for s, above in zip(order, tops):
        own, sub, paths = subs[s]
        out += [(r[0], leaf(r), sub, root, sha("".join(p + above))) for r, p in zip(own, paths)]
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_manifest_equals_whole_trees(spark):
    """A hot source of several stored levels, sources of one, two and four leaves, nulls and repeats."""
    rows = [(i, "hot", "en", i % 7, f"text {i % 50}\n") for i in range(700)] + [(800 + i, f"s{i}", None, None, "é") for i in range(9)]
    rows += [(900, "two", "de", 1, "x"), (901, "two", "de", 1, None), (None, "four", "a", 2, "b"), (None, "four", "a", 2, "c"),
             (5, "four", "a", 2, ""), (5, "four", "a", 2, ""), (6, None, None, None, None), (7, "", "x", 0, "y")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("tree", "j", "n", "hash", "path", "row", "id")})
    out = manifest_proofs(docs.repartition(7)).withColumn("folded", fold(F.col("leaf"), F.col("path")))
    got = out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("path", ""), 256), "folded").collect()
    assert all(r.folded == r.root for r in got)
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute_manifest(rows)
    assert manifest_proofs(docs.limit(0)).count() == 0


def test_a_changed_row_does_not_prove_the_root(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"line {i}\nnext") for i in range(100)], SCHEMA)
    out = manifest_proofs(docs, claimed={"text": F.when(F.col("doc_id") < 10, "other").otherwise(F.col("text"))})
    rows = out.select("doc_id", "root", fold(F.col("claimed_leaf"), F.col("path")).alias("folded")).collect()
    assert all((r.folded == r.root) == (r.doc_id >= 10) for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 26, 27, 80, 81])
def test_subtrees_grow_back(n):
    levels = regrown("".join(sha(str(i)) for i in range(n)), n)
    assert len(levels) == height(n) + 1 and len(levels[-1]) == 1
    assert len(local_paths(levels)) == n


# --- token files ------------------------------------------------------------------

def brute_lengths(counts, limit):
    """Least total size over all length vectors that satisfy Kraft's inequality."""
    used = sorted(c for c in counts if c)
    best = None

    def go(i, room, size, top):
        nonlocal best
        if best is not None and size >= best:
            return
        if i == len(used):
            best = size
            return
        for n in range(1, top + 1):  # rarer ids have no shorter codes
            if room >= 2 ** (limit - n):
                go(i + 1, room - 2 ** (limit - n), size + n * used[i], n)

    go(0, 2 ** limit, 0, limit)
    return best


def test_code_lengths_are_least():
    rng = random.Random(2)
    for _ in range(40):
        counts = np.array([rng.choice([0, 1, 2, 5, 30, 400]) for _ in range(rng.randint(2, 8))])
        if (counts > 0).sum() < 2:
            continue
        lengths = token_files.code_lengths(counts, 4)
        assert lengths.max() <= 4 and sum(2.0 ** -n for n in lengths[lengths > 0]) <= 1
        assert int((lengths * counts).sum()) == brute_lengths(counts.tolist(), 4)
    assert token_files.code_lengths(np.array([0, 0, 9])).tolist() == [0, 0, 1]
    assert token_files.code_lengths(np.ones(1000, dtype=int), 4).max() == 10  # the limit grows


def test_blocks_decode_side_by_side():
    rng = np.random.default_rng(1)
    frames = [rng.zipf(1.3, n).clip(max=3000).astype(np.int64) for n in (1, 255, 256, 257, 5000)] + [np.zeros(0, dtype=np.int64)]
    lengths = token_files.code_lengths(np.bincount(np.concatenate(frames), minlength=3001))
    codes, _, _ = token_files.canonical(lengths)
    packed = [(len(f), *token_files.pack(f, codes, lengths)) for f in frames]
    back = token_files.Decoder(lengths).unpack(packed)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(frames, back))
    longest = np.flatnonzero(lengths == lengths.max())[:1].repeat(700)  # codes that cross the words
    assert (token_files.Decoder(lengths).unpack([(700, *token_files.pack(longest, codes, lengths))])[0] == longest).all()


def test_token_files_hold_the_ids_of_the_library(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "FRAME_IDS", 500)
    rng = random.Random(4)
    word = lambda: rng.choice(["héllo", "the", "<|endoftext|>", "\n\n", "日本語", "123", "a" * 40])
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in rng.sample(range(10_000), 150)]
    rows += [(None, "none"), (None, None), (50_000, ""), (50_001, None), (50_002, "same"), (50_002, "same"), (50_003, "long text " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("id", "row", "ids", "first")})
    out = token_files.read_token_files(spark, token_files.write_token_files(docs.repartition(5), BPE)).collect()
    library = Tokenizer.from_file(BPE)
    want = sorted(((i is not None, i or 0), tuple(library.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t in rows)
    got = [(((r.doc_id is not None, r.doc_id or 0)), tuple(np.frombuffer(bytes(r.ids), "<u4").tolist()), r.start) for r in out]
    assert sorted(g[:2] for g in got) == want
    at = 0
    for key, ids, start in sorted(got, key=lambda g: (g[0], g[2])):
        assert start == at
        at += len(ids)


def test_token_files_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.read_token_files(spark, token_files.write_token_files(empty, BPE)).count() == 0


@pytest.mark.parametrize("room", [1 << 20, 3])
def test_pieces_give_the_ids_of_the_library(room, monkeypatch):
    """All kinds of white space, symbols, special strings, long pieces, windows and a memo that overflows."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "WINDOW", 7)
    with open(BPE, encoding="utf-8") as f:
        encoder = token_files.PieceEncoder(f.read(), 0, "<u2", room)
    assert encoder.by_piece
    library = Tokenizer.from_file(BPE)
    rng = random.Random(9)
    parts = [" ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x00", "\x1c", "\x85", "\xa0", " ", "　", "a", "word", "don't", "'s", ".",
             "!?", "é", "日本", "１２", "12", "<|endoftext|>", "x" * 40, "🙂", "_", "ß", "a\x00", "ſ"]
    for _ in range(60):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(20)]
        got = encoder.encode(pa.array(["cut off", *texts]).slice(1)).to_pylist()
        for text, ids in zip(texts, got):
            assert np.frombuffer(ids, "<u2").tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], repr(text)
    assert encoder.encode(pa.array([], pa.string())).to_pylist() == []


def test_other_tokenizers_get_whole_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        encoder = token_files.PieceEncoder(f.read(), 7, "<u2")
    texts = ["Some words, and MORE", "", "two  spaces"]
    want = [[*Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids, 7] for t in texts]
    assert not encoder.by_piece and [np.frombuffer(i, "<u2").tolist() for i in encoder.encode(pa.array(texts)).to_pylist()] == want
