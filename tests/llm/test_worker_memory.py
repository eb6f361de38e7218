"""What a Python worker took for a batch does not stay with it."""

import re

import public_tokenizers

from paneldeck.llm import sentencepieces as S
from paneldeck.llm.text import give_back


def _anonymous_mb():
    with open("/proc/self/status") as f:
        return int(re.search(r"RssAnon:\s+(\d+)", f.read())[1]) / 1024


def test_freed_memory_goes_back_to_the_machine():
    blocks = [b"\1" * 100_000 for _ in range(1000)]
    last = blocks.pop()  # at the end of the heap, which can't shrink below it
    held = _anonymous_mb()
    del blocks
    give_back()
    assert held - _anonymous_mb() > 60 and len(last) == 100_000


def test_sentence_pieces_come_in_small_batches(spark):
    docs = spark.createDataFrame([(1, "a few words, été"), (2, None), (3, "")], "doc_id long, text string")
    out = S.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), check=True)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == S.BATCH == "2m"
    assert {r.doc_id: (len(r.ids) > 0, r.round_trip) for r in out.collect()} == {1: (True, True), 2: (False, True), 3: (False, True)}
