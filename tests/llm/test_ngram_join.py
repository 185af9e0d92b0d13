import random
import re

import numpy as np
import pyarrow as pa

from helpers import awkward, docs_of, sentences
from vitrine.llm import linking
from vitrine.llm import ngram_join as nj


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    """(doc_id, number of shingles, component) of all rows, from all pairs."""
    sets = [shingles(t) for _, t in rows]
    above = list(range(len(rows)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, (a, (one, _)) in enumerate(zip(sets, rows)):
        for b, j, (other, _) in zip(sets[:i], range(i), rows):
            if a and b and None not in (one, other) and 100 * len(a & b) >= 80 * len(a | b):
                above[top(i)] = top(j)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[top(n)] = min(i, least.get(top(n), i))
    return sorted(((i, len(sets[n]), least.get(top(n)) if i is not None else None) for n, (i, _) in enumerate(rows)), key=str)


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def changed(text, words, pick):
    """The text with so many single words exchanged."""
    out = text.split()
    for at in pick.sample(range(len(out)), words):
        out[at] = f"n{pick.randrange(10**6)}"
    return " ".join(out)


def corpus():
    """Copies from nearly equal to hardly similar, chains, a passage that most texts hold, very common words."""
    pick = random.Random(4)
    base = sentences(8, 130)
    rows = [f"{base[0]} {t}" for t in base[1:60]]
    rows += [changed(base[61], n % 8, pick) for n in range(150)]
    rows += [changed(f"{base[0]} {base[62 + n % 20]}", pick.randint(0, 9), pick) for n in range(60)]
    text = base[90]
    for _ in range(25):
        text = changed(text, 2, pick)
        rows.append(text)
    rows += [" ".join(base[91].split()[:n]) for n in range(1, 130, 4)]
    rows += ["the same five words again"] * 30 + [base[92].upper(), base[92]]
    return [(at * 7919 % 100_003, t) for at, t in enumerate(rows)]


def test_components_are_those_of_all_pairs(spark):
    rows = corpus()
    want = plain(rows)
    assert len({c for _, _, c in want}) > 80
    assert found(nj.linked(docs_of(spark, rows))) == want


def test_small_parts_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(linking, "PART_NODES", 7)
    pick = random.Random(5)
    base = sentences(13, 90)[2]
    rows = [(n, changed(base, n % 3, pick)) for n in range(120)] + [(1000 + n, changed(base, 6 + n % 9, pick)) for n in range(40)]
    assert found(nj.linked(docs_of(spark, rows))) == plain(rows)


def test_the_search_finds_all_that_reach_the_overlap():
    pick = random.Random(6)
    sets = []
    for n in range(300):
        own = set(range(1000 * (n % 7), 1000 * (n % 7) + pick.randint(1, 60))) if n % 3 else set(pick.sample(range(90), pick.randint(1, 80)))
        sets.append(sorted(own - set(pick.sample(sorted(own), len(own) // 9))) or [5])
    held = pa.table({"shingles": pa.array([np.array(s, np.int64) for s in sets], pa.list_(pa.int64()))})
    lists = nj.InvertedLists(held)
    everyone = np.ones(len(sets), bool)
    for i, s in enumerate(sets):
        want = [j for j, t in enumerate(sets) if 100 * len(set(s) & set(t)) >= 80 * len(set(s) | set(t))]
        assert lists.near(held, i, everyone).tolist() == want
        half = np.arange(len(sets)) % 2 == 0
        assert lists.near(held, i, half).tolist() == [j for j in want if half[j]]
    stranger = pa.table({"shingles": pa.array([np.array([10**9], np.int64)], pa.list_(pa.int64()))})
    assert len(lists.near(stranger, 0, everyone)) == 0


def test_merging_runs():
    pick = np.random.default_rng(1)
    runs = [np.sort(pick.integers(0, 50, n)) for n in (0, 1, 40, 7, 7, 0, 300)]
    assert nj.heap_merged(runs).tolist() == sorted(np.concatenate(runs).tolist())
    assert len(nj.heap_merged([])) == 0


def test_awkward_and_empty_tables(spark):
    rows = [r for r in awkward()]
    assert found(nj.linked(docs_of(spark, rows))) == plain(rows)
    assert found(nj.linked(docs_of(spark, []))) == []
    same_id = [(1, "one two three four five six"), (1, "nothing of the kind at all here"), (0, "nothing of the kind at all here")]
    assert found(nj.linked(docs_of(spark, same_id))) == plain(same_id)
