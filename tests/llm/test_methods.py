"""The operators against brute force, exact round trips and the public libraries."""

import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paneldeck.llm import queries
from paneldeck.llm.chat import collapse_snapshots
from paneldeck.llm.components import connected_components
from paneldeck.llm.exact_dedup import DigestIndex, exact_dedup
from paneldeck.llm.jaccard_join import Bands, jaccard_components, jaccard_pairs
from paneldeck.llm.line_dedup import LineRuns, dedup_lines
from paneldeck.llm.mixing import first_words
from paneldeck.llm.pii import find_pii, luhn, mod97
from paneldeck.llm.sentencepieces import Lattice, encode
from paneldeck.llm.token_counts import CountTransducer
from paneldeck.llm.toxicity import labelled_sample, score_toxicity
from paneldeck.session import stage_path

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


# ---- exact dedup --------------------------------------------------------------

def test_digest_index_persists_and_goes_on(spark):
    docs = spark.createDataFrame([(5, "a  b"), (3, "a b"), (9, "c")], "doc_id long, text string")
    path = stage_path(spark, "test-index")
    exact_dedup(docs, index=DigestIndex(spark, path, buckets=4))
    later = spark.createDataFrame([(1, "a\tb"), (2, "d")], "doc_id long, text string")
    out = {r.doc_id: r for r in exact_dedup(later, index=DigestIndex(spark, path, 4, reopen=True)).collect()}
    assert (out[1].keep_id, out[1].kept) == (3, False) and (out[2].keep_id, out[2].kept) == (2, True)
    plan = DigestIndex(spark, path, 4, reopen=True).rows()
    new = spark.range(9).groupBy(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest")).count()
    text = new.hint("merge").join(plan, "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Bucketed: true" in text


# ---- quality rules ------------------------------------------------------------

def test_quality_counts_and_verdict(spark, texts):
    rows = {r.doc_id: r for r in queries.op2_quality_rules(spark, SMALL).collect()}
    for i, t in texts.items():
        w = WORD.findall(t)
        tri = Counter(zip(w, w[1:], w[2:]))
        cover = {j + k for j, g in enumerate(zip(w, w[1:], w[2:])) if tri[g] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert r.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w))
        assert not (r.kept and r.base_failed)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    judged = [(r.quality, rows[r.doc_id].kept) for r in labels if not rows[r.doc_id].base_failed]
    assert sum(q == k for q, k in judged) >= 0.95 * len(judged)


# ---- line dedup ---------------------------------------------------------------

def brute_lines(docs, least=3):
    key = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x).translate(
        {c: c + 32 for c in range(65, 91)})
    held = defaultdict(set)
    for i, t in docs.items():
        for x in t.split("\n"):
            if len(key(x)) >= 20:
                held[key(x)].add(i)
    return {i: "\n".join(x for x in t.split("\n") if len(held[key(x)]) < least or max(held[key(x)]) == i)
            for i, t in docs.items()}


def test_line_dedup_matches_brute_force_for_any_batches(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute_lines(texts)
    for batches in (1, 7):
        got = {r.doc_id: r.text or "" for r in dedup_lines(docs, batches=batches).collect()}
        assert got == want


def test_line_runs_are_compacted(spark):
    runs = LineRuns(spark, buckets=2, fanout=2)
    for i in (9, 7, 5, 3):
        runs.add(spark.createDataFrame([(i, 1, 1), (i, i, 0)], "id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert [tuple(r) for r in runs.repeated(3).collect()] == [(1, 1, 9)]


# ---- personal data ------------------------------------------------------------

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_luhn(d):
    return sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_spans(t):
    def fine(kind, v):
        d = re.sub("[^0-9]", "", v)
        return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in v.split(".")),
                "card": lambda: 12 <= len(d) <= 19 and plain_luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()
    return sorted((m.start(), no, kind, m.end()) for no, (kind, p) in enumerate(BASE)
                  for m in re.finditer(p, t) if fine(kind, m.group()))


def test_pii_base_spans_match_plain_patterns(spark, texts):
    random.seed(4)
    odd = ["a@b.c%d@e.f..g@h.i.", "1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1", "+1 (603) 555-8791+49 89 1234567 +1((((",
           "4111 1111 1111 1111 4111-1111-1111-1112 1-1-1 " + "1 " * 4000, "a" * 200_000 + "@", "9" * 100_000,
           "é日x@y.z 10.0.0.1 " * 3, "x@y." + "a." * 20_000]
    odd += ["".join(random.choice("a@.1 +-()5é") for _ in range(60)) for _ in range(300)]
    docs = {**texts, **{-1 - i: t for i, t in enumerate(odd)}}
    found = find_pii(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert len(found) == len(docs)
    for r in found:
        got = [(s.start, s.kind_no, s.kind, s.end) for s in r.spans if s.base]
        assert got == brute_spans(docs[r.doc_id]), docs[r.doc_id][:80]


def test_pii_added_kinds_need_checksum_or_context(spark):
    rows = [(1, "IBAN DE89 3704 0044 0532 0130 00."), (2, "IBAN DE89 3704 0044 0532 0130 01."),
            (3, "my ssn is 123-45-6789"), (4, "part 123-45-6789"), (5, "ssn 000-45-6789")]
    out = {r.doc_id: [s.kind for s in r.spans]
           for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: ["iban"], 2: [], 3: ["ssn"], 4: [], 5: []}
    one = spark.range(1).select(luhn(F.lit("79927398713")).alias("a"), luhn(F.lit("79927398710")).alias("b"),
                                mod97(F.lit("GB82 WEST 1234 5698 7654 32")).alias("c")).first()
    assert tuple(one) == (True, False, True)


# ---- toxicity -----------------------------------------------------------------

def test_toxicity_on_held_out_labels(spark):
    where = "/root/testdata/sf0.1"  # half of the labels of sf0.01 would hold some 25 toxic rows
    docs, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    half = labels.where("doc_id % 2 = 0")
    out = score_toxicity(docs, half).join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "label"), "doc_id")
    rows = out.select("toxic", "label", "severity", "grade").collect()
    assert sum(r.toxic == bool(r.label) for r in rows) >= 0.95 * len(rows)
    assert sum(r.toxic for r in rows if r.label) >= 0.8 * sum(r.label for r in rows)
    assert all(0 <= r.severity <= 3 and 0 <= r.grade <= 3 for r in rows)


def test_a_small_sample_rejects_no_more_clean_documents(spark):
    # 60 of the 260 documents that grumble are toxic: most of them are clean
    kinds = [("grumble", 0)] * 200 + [("", 0)] * 1400 + [("grumble", 1)] * 60 + [("vile scum", 1)] * 140
    filler = "the day was long and the road went on past old houses".split()
    rows = [(i, " ".join([*filler[i % 7:], *filler[:i % 5], word]), toxic) for i, (word, toxic) in enumerate(kinds)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([r[::2] for r in rows], "doc_id long, toxic int")
    shares = []
    for max_rows in (10_000, 400):
        found = score_toxicity(docs, labels, max_rows=max_rows).join(labels.withColumnRenamed("toxic", "label"), "doc_id")
        out = [(r.label, r.toxic) for r in found.select("label", "toxic").collect()]
        shares.append(sum(t for c, t in out if not c) / 1600)
        assert sum(t for c, t in out if c) >= 140
    assert abs(shares[0] - shares[1]) < 0.02


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    rows = [(1, f"text {i}") for i in range(50)] + [(1, None), (2, "b"), (2, "b"), (3, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    draw = lambda: sorted(tuple(r) for r in
                          labelled_sample(docs, labels, 10, "doc_id", "text", "toxic")[0].collect())
    first = draw()
    assert len(first) == 3 and first == draw()


# ---- sentence pieces ----------------------------------------------------------

@pytest.fixture(scope="module")
def lattice():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return Lattice(f.read())


def brute_n_best(lattice, text, n):
    full = lattice.prefix + text.replace(" ", "▁") if text else ""
    ends = {0: [(0.0, ())]}
    for i in range(len(full)):
        edges = [(j, *lattice.pieces[full[i:j]]) for j in range(i + 1, len(full) + 1) if full[i:j] in lattice.pieces]
        if not any(j == i + 1 for j, _, _ in edges):
            raw = full[i].encode()
            edges.append((i + 1, lattice.byte_score * len(raw), tuple(lattice.byte_ids[b] for b in raw)))
        for j, score, ids in edges:
            ends.setdefault(j, []).extend((s + score, p + ids) for s, p in ends[i])
    return sorted(ends[len(full)], key=lambda x: -x[0])[:n]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="the iné\n.日", max_size=10))
def test_n_best_segmentations_match_brute_force(lattice, text):
    got, want = lattice.n_best_ids(text, 5), brute_n_best(lattice, text, 5)
    assert [round(s, 8) for s, _ in got] == [round(s, 8) for s, _ in want]
    assert len({tuple(ids) for _, ids in got}) == len(got)
    assert all(lattice.decode(ids) == text for _, ids in got)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_pieces_round_trip(lattice, text):
    text = text.encode("utf-8", "ignore").decode()
    assert lattice.decode(lattice.encode(text, 3)[0].tolist()) == text


def test_op6_round_trip(spark):
    out = queries.op6_sentencepieces(spark, SMALL)
    assert out.where("not round_trip or n_tokens < 1").count() == 0


def test_op6_digests_all_of_the_best_segmentations(spark, texts, lattice):
    short = {i: t[:300] for i, t in texts.items()}
    docs = spark.createDataFrame([*short.items(), (-1, ""), (-2, None)], "doc_id long, text string")
    out = encode(docs, public_tokenizers.path("piece_bpe_32k.model"), full=True)
    got = {r.doc_id: r.n_best_ids for r in out.collect()}
    assert got == {i: [ids for _, ids in lattice.n_best_ids(t, 4)] for i, t in short.items()} | {-1: [[]], -2: [[]]}
    assert all(lattice.decode(ids) == t for i, t in short.items() for ids in got[i])
    whole = {i: [ids for _, ids in lattice.n_best_ids(t, 4)] for i, t in [*texts.items()][:20]}
    found = {r.doc_id: r.n_best_hash for r in queries.op6_sentencepieces(spark, SMALL).collect()}
    for i, all_ids in whole.items():
        raw = b"".join(struct.pack(f"<q{len(ids)}i", len(ids), *ids) for ids in all_ids)
        assert found[i] == xxhash.xxh3_64_intdigest(raw) - (1 << 63)


# ---- mixing -------------------------------------------------------------------

def test_first_words_keep_their_white_space(spark):
    df = spark.createDataFrame([("  a b\n\nc  d ", 3)], "t string, n int")
    assert df.select(first_words(F.col("t"), F.col("n"))).first()[0] == "  a b\n\nc"


# ---- chats --------------------------------------------------------------------

def test_snapshots_match_brute_force_for_any_stretch(spark):
    random.seed(6)
    talks = {i: [(random.choice("ub"), random.choice("xyz")) for _ in range(random.randint(1, 4))] for i in range(60)}
    rows = [(i, 3 * n + i % 5, r, t) for i, talk in talks.items() for n, (r, t) in enumerate(talk)]
    longer = {tuple(t[:k]) for t in talks.values() for k in range(1, len(t))}
    first = {}
    for i, t in sorted(talks.items()):
        first.setdefault(tuple(t), i)
    want = {i for i, t in talks.items() if tuple(t) not in longer and first[tuple(t)] == i}
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for stretch in (4, 1024):
        assert {r.conv for r in collapse_snapshots(df, stretch=stretch).where("kept").collect()} == want


# ---- Jaccard join -------------------------------------------------------------

def brute_components(docs, percent=75):
    sets = {}
    for i, t in docs.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in docs}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in docs}


def test_jaccard_join_on_given_and_hard_texts(spark, texts):
    random.seed(8)
    docs = dict(texts)
    passage = [f"p{i}" for i in range(60)]
    for k in range(120):  # one passage in many texts; copies with a few changed words; chains of small steps
        own = [f"w{random.randrange(10**6)}" for _ in range(random.randint(5, 60))]
        docs[10_000 + k] = " ".join(own + passage)
        changed = list(passage * 2)
        for _ in range(random.randint(0, 4)):
            changed[random.randrange(120)] = f"c{random.randrange(10**6)}"
        docs[20_000 + k] = " ".join(changed[random.randint(0, 8):])
        docs[30_000 + k] = " ".join(f"s{i}" for i in range(k, k + 40))
        docs[40_000 + k] = " ".join(random.choice("ab") for _ in range(random.randint(1, 12)))
    rows = jaccard_components(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(docs)


def test_jaccard_pairs_hold_every_link(spark):
    random.seed(9)
    docs = {}
    for k in range(60):  # near copies that mostly link with each other, and chains of small steps
        changed = [f"p{i}" for i in range(120)]
        for _ in range(random.randint(0, 3)):
            changed[random.randrange(120)] = f"c{random.randrange(10**6)}"
        docs[k] = " ".join(changed)
        docs[1_000 + k] = " ".join(f"s{i}" for i in range(k, k + 40))
    sets = {i: frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) for i, w in ((i, t.split()) for i, t in docs.items())}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    reps = sorted(first.values())
    want = {(a, b) for a in reps for b in reps if a < b
            and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    rows, pairs = jaccard_pairs(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    found = [tuple(r) for r in pairs.collect()]
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 100
    assert {r.id: r.rep for r in rows.collect()} == {i: first[s] for i, s in sets.items()}


def test_open_groups_give_a_pair_mostly_once(spark):
    """Many texts around one passage: each near pair is given about once, not in
    every group that its texts share, and an id with several texts links by each."""
    from pyspark.sql import functions as F
    from paneldeck.llm import jaccard_join as j
    random.seed(10)
    passage, rows = [f"p{i}" for i in range(150)], []
    for k in range(60):
        own = list(passage)
        for _ in range(random.randint(0, 3)):
            own[random.randrange(150)] = f"c{random.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    rows += [(100, " ".join(passage)), (100, " ".join(f"q{i}" for i in range(600))),
             (101, " ".join(f"q{i}" for i in range(1, 601))), (101, "q1 q2")]
    docs, bands = spark.createDataFrame(rows, "doc_id long, text string"), Bands(75)
    _, _, members, sketches = j.shared_signatures(docs, "doc_id", "text", 5, bands)
    dealt = j.dealt_blocks(members.withColumn("label", F.col("id")), sketches).cache()
    made = [tuple(r) for r in j.compare_blocks(dealt, bands).collect()]
    assert (100, 101) in made and len(set(made)) > 500
    assert len(made) < 1.1 * len(set(made)) and dealt.count() > 5 * len(rows)
    _, found = jaccard_pairs(docs)
    sets = {}
    for i, text in rows:
        w = text.split()
        sets.setdefault(i, []).append(frozenset(tuple(w[x:x + 5]) for x in range(max(1, len(w) - 4))))
    linked = lambda a, b: any(100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])
    rep = {}
    for i in sorted(sets):
        for x in sets[i]:
            rep.setdefault(x, i)
    reps = sorted({i for i in sets if any(rep[x] == i for x in sets[i])})
    assert {tuple(r) for r in found.collect()} == {(a, b) for a in reps for b in reps if a < b and linked(a, b)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ba", "\u0000", "\u00a0x", "y" * 63, "y" * 64, "y" * 130, "z" * 300]), max_size=12),
       st.sampled_from([" ", "\n", "\t  ", "\x0b\r"]), st.integers(1, 70))
def test_word_hashes_tell_words_apart_in_any_stretches(words, gap, stretch):
    from paneldeck.llm import jaccard_join as j
    data = (gap + gap.join(words)).encode()
    whole, held = j.word_hashes(data).tolist(), j.STRETCH
    try:
        j.STRETCH = stretch
        assert j.word_hashes(data).tolist() == whole
    finally:
        j.STRETCH = held
    assert len(whole) == len(words) and len(set(whole)) == len(set(words)) == len(set(zip(words, whole)))


def test_a_set_gives_no_more_signatures_than_a_partner_can_touch():
    import numpy as np
    bands, rng = Bands(75), random.Random(3)
    for size in (40, 64, 65, 100, 128, 500, 1000):
        features = np.sort(np.array([rng.getrandbits(64) for _ in range(size)], dtype=np.uint64))
        for level in bands.levels(size):
            partner = min(1 << level, 100 * size // 75)
            most = max(bands.most_apart(size, partner) + 1, bands.partitions(level) if size < 100 else 0)
            assert len(bands.signatures(features, level)) <= most


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 300), st.integers(0, 10**6))
def test_linked_sets_share_a_signature(size, seed):
    import numpy as np
    bands, rng = Bands(75), random.Random(seed)
    a = {rng.getrandbits(64) for _ in range(size)}
    b = set(a)
    while True:
        other = set(b)
        if rng.random() < 0.5 and other:
            other.remove(rng.choice(sorted(other)))
        else:
            other.add(rng.getrandbits(64))
        if 100 * len(a & other) < 75 * len(a | other):
            break
        b = other
    array = lambda s: np.sort(np.array(list(s), dtype=np.uint64))
    sigs = lambda s: set(np.concatenate([bands.signatures(array(s), x) for x in bands.levels(len(s))]).tolist())
    assert sigs(a) & sigs(b)


def test_components_of_long_chains_and_stars(spark):
    links = [(i + 1, i) for i in range(40)] + [(100, i) for i in range(101, 300)] + [(7, 7)]
    got = {r.v: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 300)}}


# ---- token counts -------------------------------------------------------------

@pytest.fixture(scope="module")
def machine():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return CountTransducer(f.read())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="ab'st re1²\n\t  <|endoftx>é日", max_size=40), st.integers(1, 9),
       st.booleans())
def test_counts_match_the_library_for_any_chunks(machine, library, text, chunk, special):
    text = text.encode("utf-8", "ignore").decode() + "<|endoftext|> x" * special
    want = len(library.encode(text, add_special_tokens=False).ids)
    assert machine.count(text) == want
    maps = [machine.state_map(text[i:i + chunk]) for i in range(0, max(1, len(text)), chunk)]
    assert machine.total(machine.scan(maps)) == want


def test_op10_matches_the_library(spark, texts, library):
    from paneldeck.llm.token_counts import count_tokens
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = {i: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in texts.items()}
    for chunk in (100, 16_384):
        got = {r.doc_id: (r.n_bytes, r.n_tokens)
               for r in count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), chunk_chars=chunk).collect()}
        assert got == want


# ---- SQL ----------------------------------------------------------------------

@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_oracles(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    query, sql = queries.QUERIES[name]
    out = query(spark, SMALL)
    want = con.execute(sql)
    order = [c[0] for c in want.description]
    norm = lambda rows: sorted(tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert sorted(order) == sorted(out.columns)
    assert norm(out.select(*order).collect()) == norm(want.fetchall())


# ---- the pipeline -------------------------------------------------------------

def test_pipeline_stages(spark, texts):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    clean = p.toxicity(spark, docs, SMALL)
    kept = {r.doc_id: r.text for r in clean.collect()}
    lined = p.line_dedup(spark, clean, SMALL)
    after = {r.doc_id: r.text or "" for r in lined.collect()}
    assert after == brute_lines(kept) and lined.columns == columns
    near = p.ngram_jaccard(spark, lined, SMALL)
    single = {r.doc_id: r.text for r in near.collect()}
    assert set(single) == {c for _, c in brute_components(after).values()} and near.columns == columns
    mixed = p.mixing(spark, near, SMALL)
    assert mixed.columns == columns and {r.doc_id for r in mixed.select("doc_id").collect()} <= set(single)
    last = p.sentencepieces(spark, mixed, SMALL)
    assert set(columns) < set(last.columns) and last.count() == mixed.count()


def test_digest_of_kept_lines(spark, texts):
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in brute_lines(texts).items()}
    assert {r.doc_id: r.kept_sha256 for r in queries.op3_line_dedup(spark, SMALL).collect()} == want
