import random

import pytest
import sentencepiece

from helpers import awkward, docs_of
from vitrine.llm import pieces

SIGNS = "aeiouthnsr  \n\t▁▁éßñ中文😀.,;=/\\\"0123456789"


@pytest.fixture(scope="module")
def data():
    with open(pieces.MODEL, "rb") as file:
        return file.read()


def texts():
    pick = random.Random(4)
    made = ["".join(pick.choice(SIGNS) for _ in range(pick.randint(0, 200))) for _ in range(600)]
    return made + [t for _, t in awkward() if t] + ["." * 3000, " " * 900, "ab" * 900, "representations" * 200, "\x00", "\r\n"]


def test_ids_and_texts_are_those_of_the_library(data):
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.Codec(data)
    for text in texts():
        ids = library.encode(text)
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids)
        assert own.decode(ids) == text.replace("▁", " ")


def test_scores_are_added_up_in_a_unigram_model(data):
    # The same pieces, declared a unigram model; texts of known characters, as byte pieces drown the scores.
    at = 0
    patched = bytearray(data)
    while at < len(data):
        key, body = pieces._varint(data, at)
        size, body = pieces._varint(data, body)
        if key >> 3 == 2:
            patched[body + data[body : body + size].index(b"\x18\x02") + 1] = 1
        at = body + size
    library, own = sentencepiece.SentencePieceProcessor(model_proto=bytes(patched)), pieces.Codec(bytes(patched))
    assert own.model.type == pieces.UNIGRAM
    pick = random.Random(8)
    for _ in range(400):
        text = " ".join("".join(pick.choice("aeioutsnrlm.,") for _ in range(pick.randint(1, 9))) for _ in range(6))
        score = lambda ids: sum(own.model.score[own.model.pieces[i]] for i in ids)
        mine, theirs = own.encode(text), library.encode(text)
        assert score(mine) == score(theirs)  # another path of the same score is as good
        assert own.decode(mine) == text


def test_the_window_does_not_grow_with_the_text(data):
    model = pieces.PieceModel(data)
    search = pieces.StreamingViterbi(model)
    out, widest = [], 0
    for n in range(300):
        out += search.feed("........abababab" * 7)
        widest = max(widest, search.window)
    out += search.finish()
    assert widest <= 4 * model.longest + pieces.CHECK_EVERY
    assert out == sentencepiece.SentencePieceProcessor(model_proto=data).encode("........abababab" * 2100)[-len(out) :]


def test_awkward_and_empty_tables(spark):
    rows = awkward()
    out = pieces.encoded(docs_of(spark, rows))
    got = out.collect()
    assert len(got) == len(rows) and all(r.lossless and r.n_ids == len(r.ids) for r in got)
    back = {(r.doc_id, r.text) for r in pieces.decoded(out).collect()}
    assert back == {(i, (t or "").replace("▁", " ")) for i, t in rows}
    assert pieces.encoded(docs_of(spark, [])).count() == 0
