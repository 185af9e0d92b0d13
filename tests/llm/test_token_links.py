import base64
import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from helpers import awkward, docs_of, sentences
from vitrine.llm import token_links as tl

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(tl.A_PATH)
    a.encode_special_tokens = True
    with open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb") as file:  # the same vocabulary, as bytes
        a_bytes = {int(n): base64.b64decode(t) for t, n in (line.split() for line in file)}
    return a, a_bytes, sentencepiece.SentencePieceProcessor(model_file=tl.B_PATH)


def groups_of(text, libraries):
    """[(A ids, B ids)] of one text, by whole texts and sets of offsets."""
    a, a_bytes, b = libraries
    if not text:
        return []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts_a = [a_bytes[i] for i in ids_a]
    parts_b = [bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, b.id_to_piece(ids_b))]
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return []
    ends = [np.cumsum([len(p) for p in parts]).tolist() for parts in (parts_a, parts_b)]
    both = set(ends[0]) & set(ends[1])
    lists = []
    for ids, end in zip((ids_a, ids_b), ends):
        lists.append([[]])
        for i, e in zip(ids, end):
            lists[-1][-1].append(i)
            if e in both:
                lists[-1].append([])
    return [(x, y) for x, y in zip(*lists) if x]


def plain(rows, libraries):
    groups = [groups_of(t, libraries) for _, t in rows]
    linked = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(pair for one in linked for pair in one)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (doc_id, _), g, own in zip(rows, groups, linked):
        form = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((
            doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), own.total(), sum(n for p, n in own.items() if count[p] == best[p[0]]),
            sum(n * count[p] for p, n in own.items()), hashlib.sha256(form.encode()).hexdigest() if form else "",
        ))
    return sorted(out, key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


TEXTS = [
    "The quick brown fox; it's 12345 o'clock... <|endoftext|> and </s><s> are plain.", "  two  spaces\n\n\nthree lines \t tab\r\n end  ", "\n", " ", "   ",
    "naïve café — “quotes” …", "日本語のテキスト、漢字。\n한국어 텍스트", "emoji 👩‍👩‍👧‍👦 and flags 🇫🇷!", "ÅÄÖåäö nbsp em　wide\x85next\x1cfs", "a" * 3000, "ab " * 2000,
    "á combining", "under▁mark", "tail space ", "\tlead tab", "x\n y\n  z", "𝔘𝔫𝔦𝔠𝔬𝔡𝔢 𒀀𒁀 " * 50, "<0x41> <unk>",
]


def test_alignment_is_that_of_whole_texts(spark, libraries):
    rows = [(n, t) for n, t in enumerate(TEXTS * 2 + [t.capitalize() for t in sentences(4, 60)])]
    want = plain(rows, libraries)
    assert sum(r[3] > 0 for r in want) > len(rows) - 5
    assert found(tl.aligned(docs_of(spark, rows))[0]) == want
    # The same if most counts come by the join, or all of them.
    assert found(tl.aligned(docs_of(spark, rows), head_pairs=20)[0]) == want
    assert found(tl.aligned(docs_of(spark, rows), head_pairs=0)[0]) == want


def test_counts_of_all_pairs(spark, libraries):
    rows = [(n, t) for n, t in enumerate(sentences(9, 20) * 2)]
    count = Counter(p for _, t in rows for p in {(x, y) for a, b in groups_of(t, libraries) for x in a for y in b})
    _, pairs = tl.aligned(docs_of(spark, rows))
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(count)


def test_lanes_and_batches_change_nothing(monkeypatch, libraries):
    texts = TEXTS + sentences(3, 30) + ["word " * 5000]
    forms = [";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups_of(t, libraries)) for t in texts]
    for lane in (2, 7, 10_000):
        monkeypatch.setattr(tl, "LANE", lane)
        assert tl.aligned_texts(texts)["form"] == forms
    for one in texts[:8]:
        assert tl.aligned_texts([one])["form"] == [forms[texts.index(one)]]


def test_known_words_are_bounded(monkeypatch, libraries):
    monkeypatch.setattr(tl, "KNOWN_WORDS", 10)
    texts = sentences(6, 12)
    for text in texts:
        got = tl.aligned_texts([text])
        assert got["n_groups"][0] == len(groups_of(text, libraries))


def test_large_groups_are_paired_by_different_ids(monkeypatch, libraries):
    texts = ["日本語" * 40 + " plain", "한국어 " * 20]
    whole = tl.aligned_texts(texts)
    monkeypatch.setattr(tl, "GROUP_PAIRS", 2)
    apart = tl.aligned_texts(texts)
    for key in ("pair", "times", "pairs_end"):
        assert (whole[key] == apart[key]).all()


def test_awkward_and_empty_tables(spark, libraries):
    rows = awkward()
    assert found(tl.aligned(docs_of(spark, rows))[0]) == plain(rows, libraries)
    assert found(tl.aligned(docs_of(spark, []))[0]) == []
