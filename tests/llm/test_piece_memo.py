"""Pieces are learnt by the words in them and found by their exact bytes."""

import numpy as np
import pyarrow as pa
import public_tokenizers

from paneldeck.llm import memo as M
from paneldeck.llm import token_files as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["it's it's. it'S, don't!' 'tis we'll... they'd? he''s, '' 's' '.'s a.'re x'", "word word. word, word!! word?! (word) [word]; w0rd0. 3.14, 7%",
         "eau, d'été. été! naïve... ÿ. Ð, × ×. ÷! a×. é×, ñ's ñ. ü%", "a<|endoftext|> a<|endoftext|>. b|> b| c<| x<|endoftext|>,,",
         "日本語. 日本語, é. é,  a. b ,  c.", "", " ", "end.\n\n  end.\t!\r\nend", "Ã. Ń. Ńx, \x7f. a\x7f. a\x00. \x00!",
         "abcdefghijklmno. abcdefghijklmnopq. abcdefghijklm,.!?"]


def _encoder(room=1 << 20):
    with open(PATH, encoding="utf-8") as f:
        return T.PieceEncoder(f.read(), 0, "<u2", room)


def _ids(encoder, texts):
    return [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(pa.array(texts, pa.string())).to_pylist()]


def _library(texts):
    from tokenizers import Tokenizer
    return [[*e.ids, 0] for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_marks_apart_give_the_librarys_ids():
    encoder = _encoder()
    for texts in (TEXTS, TEXTS[::-1], ["".join(TEXTS)], [" ".join(TEXTS)] * 2):
        assert _ids(encoder, texts) == _library(texts)


def test_a_known_word_is_not_encoded_again_with_marks():
    encoder, sent, whole = _encoder(), [], T.PieceEncoder.whole
    encoder.whole = lambda texts: sent.extend(texts) or whole(encoder, texts)
    _ids(encoder, ["a bleething été ."])
    del sent[:]
    assert _ids(encoder, ["a bleething, a bleething. été!"]) == _library(["a bleething, a bleething. été!"])
    assert sent and not any("bleething" in t.decode() for t in sent)  # before: sent again with each mark


def test_new_pieces_go_to_the_library_in_short_texts():
    encoder, sent, whole = _encoder(), [], T.PieceEncoder.whole
    encoder.whole = lambda texts: sent.extend(map(len, texts)) or whole(encoder, texts)
    text = " ".join(f"w{i}x" for i in range(20 * T.TOGETHER))
    assert _ids(encoder, [text]) == _library([text])
    assert max(sent) <= T.TOGETHER * M.KEY  # before: all in one text


def test_memo_finds_exact_bytes_through_slots_and_after_forgetting():
    memo, learnt = M.ByteMemo(4), []
    def rows(*pieces):
        blob = b"".join(pieces)
        ends = np.cumsum([len(p) for p in pieces])
        def learn(new):
            learnt.extend(pieces[i] for i in new)
            return np.ones(len(new), dtype=bool)
        return memo.rows(np.frombuffer(blob or b" ", dtype=np.uint8), ends - [len(p) for p in pieces], ends, learn)

    first = rows(b"a", b"a\0", b"ab", b"abcdefgh", b"abcdefghijklmnop", b"a", b"", b"abcdefghijklmnopq")
    assert len(learnt) == 5 and first[0] == first[5] and list(first[6:]) == [-1, -1] and len(set(first[:5])) == 5
    assert [learnt[r] for r in rows(b"ab", b"a\0", b"abcdefgh", b"zz", b"ab")] == [b"ab", b"a\0", b"abcdefgh", b"zz", b"ab"]
    memo.slots[:] = 0  # a slot taken by another row: found by its hash
    assert [learnt[r] for r in rows(b"abcdefghijklmnop", b"zz")] == [b"abcdefghijklmnop", b"zz"]
    memo.room = 20
    learnt[:] = [learnt[i] for i in memo.shrink()]
    kept = len(learnt)
    assert [learnt[r] for r in rows(b"zz", b"a", b"ab")] == [b"zz", b"a", b"ab"] and 0 < kept <= len(learnt)


def test_small_room_gives_the_same_ids():
    encoder = _encoder(room=8)
    for _ in range(4):
        assert _ids(encoder, TEXTS) == _library(TEXTS)
