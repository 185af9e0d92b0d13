import math
import random
import zlib

import numpy as np
import pytest

from helpers import awkward
from vitrine.llm import language

SOUNDS = {"aa": ["lo", "mi", "ra", "ne"], "bb": ["tz", "kr", "ung", "sch"], "cc": ["ço", "éa", "oux", "ère"]}
SCHEMA = "doc_id bigint, text string, lang string, source string, score string, n string, place string"


def corpus(n=300):
    pick = random.Random(1)
    rows = []
    for i in range(n):
        lang = pick.choice(list(SOUNDS))
        text = " ".join("".join(pick.choice(SOUNDS[lang]) for _ in range(pick.randint(1, 4))) for _ in range(pick.randint(2, 30)))
        rows.append((i, text, lang, "s", "x", "x", "x"))
    return rows


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == language.HELD_OUT


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.createDataFrame(corpus(), SCHEMA))


def test_held_out_documents_get_their_language(model):
    rows = [r for r in corpus() if held(r[0])]
    names, share = model.predict([r[1] for r in rows])
    assert sum(a == r[2] for a, r in zip(names, rows)) / len(rows) >= 0.99
    assert ((share > 1 / 3) & (share <= 1)).all()


def test_held_out_rows_are_never_read(spark, model):
    rows = [(i, "zzz zzz", "zz", *rest) if held(i) else (i, t, lang, *rest) for i, t, lang, *rest in corpus()]
    other = language.fit(spark.createDataFrame(rows, SCHEMA))
    assert other.languages == model.languages and (other.log_probability() == model.log_probability()).all()


def test_predictions_are_those_of_plain_naive_bayes(model):
    """Counts in dictionaries, every n-gram one by one."""
    places = {}

    def place(gram):
        if gram not in places:
            places[gram] = [int(p) for part, _ in language.places([gram.replace(" ", "") or gram]) for p in part]
        return places[gram]

    def grams(text):
        # Places of all sequences of a text, through its words alone.
        return [p for word in "".join(c if c.isalpha() else " " for c in text.lower()).split() for p in place(word)]

    rows = [r for r in corpus() if not held(r[0])]
    counts, docs = {}, {}
    for _, text, lang, *_ in rows:
        docs[lang] = docs.get(lang, 0) + 1
        held_counts = counts.setdefault(lang, {})
        for p in grams(text):
            held_counts[p] = held_counts.get(p, 0) + 1
    names = sorted(counts)
    for _, text, *_ in [r for r in corpus() if held(r[0])]:
        scores = []
        for lang in names:
            total = sum(counts[lang].values()) + language.SMOOTHING * language.PLACES
            scores.append(math.log(docs[lang] / len(rows)) + sum(math.log((counts[lang].get(p, 0) + language.SMOOTHING) / total) for p in grams(text)))
        name, share = model.predict([text])
        assert name == [names[max(range(len(names)), key=lambda k: scores[k])]]
        assert share[0] == pytest.approx(1 / sum(math.exp(s - max(scores)) for s in scores), rel=1e-4)


def test_more_languages_than_ever(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(n, " ".join([letters[n % 26] + letters[n // 26 % 26] + letters[n // 676]] * 5), f"l{n:04d}", "s", "x", "x", "x") for n in range(1500)]
    many = language.fit(spark.createDataFrame(rows, SCHEMA))
    taught = [r for r in rows if not held(r[0])]
    assert len(many.languages) == len(taught) > 1000
    names, _ = many.predict([r[1] for r in taught])
    assert sum(a == r[2] for a, r in zip(names, taught)) >= 0.99 * len(taught)


def test_long_texts_are_cut_between_words(monkeypatch):
    from vitrine.llm import letters

    text = "eins,zwei\ndrei。" * 40 + "x" * 90 + " " + "中文字，" * 30
    whole = [np.sort(np.concatenate([p for p, _ in language.places([text])]))]
    for size in (7, 50, 64):
        monkeypatch.setattr(letters, "SLICE", size)
        assert (np.sort(np.concatenate([p for p, _ in language.places([text])])) == whole[0]).all()


def test_the_sample_is_bounded(spark):
    model = language.fit(spark.createDataFrame(corpus(), SCHEMA), max_docs=20)
    rows = [r for r in corpus() if held(r[0])]
    assert sum(a == r[2] for a, r in zip(model.predict([r[1] for r in rows])[0], rows)) / len(rows) >= 0.95


def test_sequences_stay_inside_words():
    import numpy as np

    both = [np.sort(p) for p, _ in language.places(["ab cd"])][0]
    apart = np.sort(np.concatenate([p for x in ("ab", "cd") for p, _ in language.places([x])]))
    assert (both == apart).all()


def test_awkward_and_empty_tables(spark, model):
    docs = spark.createDataFrame([(i, t, "aa", "s", "x", "x", "x") for i, t in awkward()], SCHEMA)
    out = language.with_language(docs, model, score="how sure")
    assert out.columns == [*docs.columns, "lang_pred", "how sure"]
    for row in out.collect():
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred in model.languages and 0 < row["how sure"] <= 1) if letters else (row.lang_pred, row["how sure"]) == ("und", 0.0)
    assert language.with_language(docs.limit(0), model, score="how sure").count() == 0
    untaught = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.with_language(docs, untaught, score="how sure").collect()} == {"und"}


def test_null_languages_do_not_teach(spark, model):
    rows = corpus() + [(1000 + i, "qqq qqq", None, "s", "x", "x", "x") for i in range(50)]
    assert language.fit(spark.createDataFrame(rows, SCHEMA)).languages == model.languages
