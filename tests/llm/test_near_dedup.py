import random
from collections import Counter

import numpy as np
import pytest

from helpers import awkward, docs_of, sentences
from vitrine.llm import linking
from vitrine.llm import near_dedup as nd


def bag(text):
    words = nd._WORD.findall((text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else None


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def plain(rows):
    """Class of every (doc_id, text) with an id, from all pairs."""
    bags = [bag(t) for _, t in rows]
    above = list(range(len(rows)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and None not in (rows[i][0], rows[j][0]) and similarity(bags[i], bags[j]) >= nd.SIMILAR:
                above[top(i)] = top(j)
    ids = {}
    for n, (i, t) in enumerate(rows):
        ids.setdefault(top(n), []).append(i)
    return sorted(((rows[n][0], min(x for x in ids[top(n)] if x is not None) if rows[n][0] is not None else None, len(ids[top(n)])) for n in range(len(rows))), key=str)


def found(df):
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in df.collect()), key=str)


def changed(text, share, pick):
    return " ".join(w if pick.random() > share else f"n{pick.randrange(10**6)}" for w in text.split())


def corpus():
    """Texts of their own, copies changed a little to a lot, copies in a chain, repeated lines, a shared passage."""
    pick = random.Random(11)
    lines = sentences(5, 120)
    rows, at = [], 0

    def add(text):
        nonlocal at
        rows.append((at * 7 % 100_003, text))
        at += 1

    passage = lines[0]
    for n in range(60):
        add(f"{passage} {lines[n % 50 + 1]}" if n % 3 else lines[n % 50 + 60])
    for n in range(160):  # one base, from nearly equal to hardly similar
        add(changed(lines[118], n / 160 * 0.12, pick))
    text = lines[117]
    for _ in range(25):  # each like the one before
        text = changed(text, 0.012, pick)
        add(text)
    for n in range(20):  # weights matter: a line repeated more and more often
        add(" ".join([lines[116][:60]] * (n + 1)) + " " + lines[115][:300])
    for _ in range(40):
        add(lines[114])
    return rows


def test_classes_are_those_of_all_pairs(spark):
    rows = corpus()
    assert found(nd.classes(docs_of(spark, rows))) == plain(rows)


def test_a_graded_group_in_small_parts(spark, monkeypatch):
    """Most of its rows are near to many others, but not all rows to all."""
    monkeypatch.setattr(linking, "PART_NODES", 20)
    pick = random.Random(3)
    base = sentences(21, 150)[3]
    rows = [(n, changed(base, 0.004, pick)) for n in range(60)] + [(100 + n, changed(base, 0.045, pick)) for n in range(60)]
    assert len({c for _, c, _ in plain(rows)}) > 5
    assert found(nd.classes(docs_of(spark, rows))) == plain(rows)


def test_signatures_estimate_weighted_similarity():
    pick = random.Random(7)
    agree, truth = [], []
    for n in range(60):
        a = {k: pick.choice([1, 1, 1, 2, 3, 9, 40]) for k in range(pick.randint(1, 200))}
        b = {k + 10_000 * (pick.random() < n / 80): max(1, w + pick.choice([-1, 0, 0, 5])) for k, w in a.items()}
        owner = np.array([0] * len(a) + [1] * len(b))
        sequence = nd._mixed(np.array([*a, *b], np.uint64) + np.uint64(n * 10**6 + 1), nd._M[0])
        weight = np.array([*a.values(), *b.values()])
        signed = nd.signatures(2, owner, sequence, weight)
        agree.append((signed[0] == signed[1]).mean())
        truth.append(similarity(Counter(a), Counter(b)))
    error = np.array(agree) - np.array(truth)
    assert abs(error.mean()) < 0.02 and np.abs(error).max() < 5 * 0.5 / nd.COORDINATES**0.5


def test_a_text_has_the_same_signature_in_any_company():
    texts = [t for t in sentences(2, 30)] + ["a", "a b", " ".join(["again"] * 5000)]
    together = nd.weighted_sets(texts)
    signed = nd.signatures(len(texts), *together[1:])
    for n, text in enumerate(texts):
        alone = nd.weighted_sets([text])
        assert (nd.signatures(1, *alone[1:])[0] == signed[n]).all() and alone[0][0] == together[0][n]


def test_units_have_the_similarity_of_the_weights():
    a, b = "x y z x y z x y z x y z q r s", "x y z x y z x y z x y z x y z q r s"
    owner, units = nd.elements(*nd.weighted_sets([a, b])[1:])
    sets = [set(units[owner == k].tolist()) for k in (0, 1)]
    assert len(sets[0] & sets[1]) / len(sets[0] | sets[1]) == pytest.approx(similarity(bag(a), bag(b)))


def test_awkward_and_empty_tables(spark):
    rows = awkward()
    assert found(nd.classes(docs_of(spark, rows))) == plain(rows)
    assert found(nd.classes(docs_of(spark, []))) == []
    docs = docs_of(spark, rows)
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        {(i, t) for i, t in rows if i is not None and i != 7} | {(i, t) for i, t in rows if i is None}, key=str
    )


def test_nothing_that_grows_with_the_documents_is_broadcast(spark, monkeypatch, tmp_path):
    """Written tables pass for small by their files, and an explode for adding nothing."""
    plans = []

    def stored(df, what):
        plans.append((what, df._jdf.queryExecution().executedPlan().toString()))
        path = str(tmp_path / str(len(plans)))
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    monkeypatch.setattr(nd, "stored", stored)
    monkeypatch.setattr(linking, "stored", stored)
    monkeypatch.setattr(linking, "PART_NODES", 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        result = nd.classes(docs_of(spark, corpus()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {what for what, _ in plans} == {"sketches", "nodes", "buckets", "elements", "groups", "links", "labels", "mixed-groups"}
    sizes_of_groups = ("groups", "mixed-groups")  # a row per group, measured before it is sent
    assert [what for what, plan in plans if "Broadcast" in plan and what not in sizes_of_groups] == []
    assert found(result) == plain(corpus())
