import random
import zlib

import numpy as np
import pytest

from helpers import CLASHING, DOCS, awkward, docs_of, sentences
from plain_toxicity import kneser_ney
from vitrine.llm import toxicity

BAD = ["grubnak", "zivotch", "wuxpollo", "quarnegg"]


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3


def corpus(n=400, seed=2):
    """(doc_id, text), {doc_id: label}: a toxic text has one or two bad words, with any ending."""
    pick = random.Random(seed)
    lines = sentences(seed, 25)
    rows, labels = [], {}
    for i in range(n):
        words = " ".join(pick.choice(lines) for _ in range(pick.randint(1, 4))).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                words.insert(pick.randrange(len(words)), pick.choice(BAD) + pick.choice(["", "s", "en", "ly", "ing"]))
        rows.append((i, " ".join(words)))
        labels[i] = int(toxic)
    return rows, labels


def table_of(spark, labels):
    return spark.createDataFrame([(i, 1, t) for i, t in labels.items()], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    return rows, labels, toxicity.fit(docs_of(spark, rows), table_of(spark, labels))


def test_held_out_texts_are_told_apart(fitted):
    rows, labels, model = fitted
    scorer = toxicity.Scorer(model)
    held = [(i, t) for i, t in rows if fold(i) == toxicity.HELD_OUT]
    score = model.probability(scorer.differences([t for _, t in held]))
    toxic = np.array([labels[i] for i, _ in held])
    assert ((score >= toxicity.REJECT) == toxic).mean() >= 0.97
    assert (score[toxic == 0] >= toxicity.REJECT).mean() <= 0.02
    # A word never counted, but built like the bad ones.
    assert scorer.differences([f"{rows[1][1]} wuxpollards here"])[0] > scorer.differences([rows[1][1]])[0] + 1


def test_differences_do_not_grow_with_the_length_of_ordinary_texts(fitted):
    scorer = toxicity.Scorer(fitted[2])
    lines = sentences(2, 25)
    means = [scorer.differences([" ".join(random.Random(n * 100 + k).choices(lines, k=k)) for n in range(40)]).mean() for k in (1, 10, 100)]
    assert max(means) - min(means) < 0.3
    # The mean ratio of two texts written one after the other is the mean of theirs.
    one, two = "grubnak is here", "lines of plain text"
    d = scorer.differences([one, two, f"{one} {two}"])
    assert np.exp(d[2]) == pytest.approx((3 * np.exp(d[0]) + 4 * np.exp(d[1])) / 7)


def test_held_out_labels_are_never_read(spark, fitted):
    rows, labels, model = fitted
    turned = {i: 1 - t if fold(i) == toxicity.HELD_OUT else t for i, t in labels.items()}
    other = toxicity.fit(docs_of(spark, rows), table_of(spark, turned))
    assert (other.grams == model.grams).all() or set(other.grams) == set(model.grams)
    assert (other.slope, other.offset) == pytest.approx((model.slope, model.offset))


def test_probabilities_of_a_context_sum_to_one():
    """What the model calls a log ratio comes from two distributions: check one on its own counts."""
    words = {"abab": (4, 1), "abac": (1, 6), "bbca": (2, 2)}
    counts = {}
    for word, (t, o) in words.items():
        padded = " " * (toxicity.ORDER - 1) + word + " "
        for i in range(len(word) + 1):
            gram = padded[i : i + toxicity.ORDER]
            held = counts.setdefault(gram, [0, 0])
            held[0] += t
            held[1] += o
    points = np.array([[ord(c) for c in g] for g in counts], np.uint32)
    toxic, ordinary = (np.array([c[k] for c in counts.values()]) for k in (0, 1))
    model = kneser_ney(points, toxic, ordinary)
    # exp(value) is the ratio of both probabilities: weighted by the ordinary ones it averages to at most one.
    same = kneser_ney(points, toxic, toxic)
    assert np.allclose(same.gram_values, 0) and np.allclose(same.context_values, 0)
    value = dict(zip(counts, model.gram_values))
    assert value["   aba"[-6:]] < value["  abab"] or value["  abab"] > value["  abac"]


def test_differences_match_a_plain_version(fitted):
    _, _, model = fitted
    scorer = toxicity.Scorer(model)
    word = lambda w: scorer.differences([w])[0]
    words = ["one", "grubnak", "two", "zivotching", "three"]
    each = [word(w) for w in words]
    assert scorer.differences(["  One, GRUBNAK -- two! zivotching; three"])[0] == pytest.approx(np.log(np.mean(np.exp(each))))
    texts = ["", None, "one", "123", "one grubnak"] * 3
    assert scorer.differences(texts) == pytest.approx([0, 0, each[0], 0, np.log((np.exp(each[0]) + np.exp(each[1])) / 2)] * 3)


def test_long_texts_are_cut_between_words(fitted, monkeypatch):
    _, _, model = fitted
    text = " ".join(sentences(9, 60)) + " grubnak zivotch"
    whole = toxicity.Scorer(model).differences([text, "x", text])
    monkeypatch.setattr("vitrine.llm.letters.SLICE", 64)
    assert toxicity.Scorer(model).differences([text, "x", text]) == pytest.approx(whole)


def test_awkward_documents_keep_rows_and_columns(spark, fitted):
    _, _, model = fitted
    docs = docs_of(spark, awkward())
    out = toxicity.with_scores(docs, model, score="the score")
    rows = out.collect()
    assert len(rows) == len(awkward()) and out.columns == [*docs.columns, "the score"]
    assert all(0 <= r["the score"] <= 1 for r in rows)
    clean = toxicity.without_toxic(docs, table_of(spark, {}))
    assert clean.columns == docs.columns and clean.count() == len(awkward())


def test_empty_tables_and_one_class(spark, fitted):
    rows, labels, _ = fitted
    docs = docs_of(spark, rows[:20])
    for some in ({}, {i: 0 for i in range(20)}, {None: 1, 1: None}):
        assert toxicity.without_toxic(docs, table_of(spark, some)).count() == 20
    empty = spark.createDataFrame([], DOCS + "".join(f", {c} string" for c in CLASHING))
    assert toxicity.without_toxic(empty, table_of(spark, labels)).count() == 0


def with_equal_texts(spark, n):
    """The corpus and n texts without letters, every fourth of them toxic: at the difference 0 a quarter is."""
    rows, labels = corpus()
    more = spark.range(1000, 1000 + n)
    docs = docs_of(spark, rows).select("doc_id", "text").unionByName(more.selectExpr("id doc_id", "'123' text"))
    return docs, table_of(spark, labels).select("doc_id", "toxic").unionByName(more.selectExpr("id doc_id", "int(id % 4 = 0) toxic"))


def test_a_sample_gives_the_probabilities_of_all_rows(spark):
    docs, known = with_equal_texts(spark, 6000)
    whole = toxicity.fit(docs, known)
    for thinned in (toxicity.fit(docs, known, max_docs=600), toxicity.fit(docs, known, max_chars=6000)):
        assert thinned.probability(np.zeros(1)) == pytest.approx(whole.probability(np.zeros(1)), abs=0.05)


def test_equal_differences_all_weigh(spark):
    docs, known = with_equal_texts(spark, 48_000)
    assert toxicity.fit(docs, known).probability(np.zeros(1))[0] == pytest.approx(0.25, abs=0.02)


def test_every_gram_of_the_sample_is_kept_as_in_the_plain_form(spark):
    rows, labels = corpus(150)
    rows += [(1000 + i, f"é中{i} rare{chr(97 + i % 26)}{chr(97 + i // 26)}word 😀x") for i in range(60)]
    labels |= {1000 + i: i % 2 for i in range(60)}
    drawn, _ = toxicity._sample(docs_of(spark, rows), table_of(spark, labels), toxicity.MAX_CHARS, toxicity.MAX_DOCS)
    counts = toxicity._gram_counts(drawn)
    held = counts.collect()
    points = np.array([[ord(c) for c in r.gram] for r in held], np.uint32)
    n = lambda toxic, halves: np.array([sum(r[f"n{h}{toxic}"] for h in halves) for r in held])
    models = toxicity._models(counts)
    assert len(models["w"].grams) == len(held)
    for part, halves in (("a", [0]), ("b", [1]), ("w", [0, 1])):
        plain, got = kneser_ney(points, n(1, halves), n(0, halves)), models[part]
        for keys, values in (("grams", "gram_values"), ("contexts", "context_values")):
            want = dict(zip(getattr(plain, keys).tolist(), getattr(plain, values).tolist()))
            assert dict(zip(getattr(got, keys).tolist(), getattr(got, values).tolist())) == pytest.approx(want, abs=1e-5)
