import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import linking


def near():
    class Near:
        """Numbers are similar if at most 3 apart."""

        def __init__(self, held):
            self.at = held["at"].to_numpy()

        def near(self, rows, i, others):
            return np.flatnonzero(others & (np.abs(self.at - rows["at"][i].as_py()) <= 3))

    return Near  # made in a function, workers can't import this file


def plain(buckets, at):
    above = {}

    def top(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for nodes in buckets.values():
        for a in nodes:
            for b in nodes:
                if abs(at[a] - at[b]) <= 3 and top(a) != top(b):
                    above[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for nodes in buckets.values() for n in nodes}


def run(spark, buckets, at):
    rows = [(b, n, 1) for b, nodes in buckets.items() for n in nodes]
    table = spark.createDataFrame(rows, "bucket bigint, node bigint, weight bigint")
    payload = spark.createDataFrame(list(at.items()), "node bigint, at bigint")
    return {r.node: r.component for r in linking.connected(table, payload, near()).collect()}


def test_components_over_overlapping_buckets(spark, monkeypatch):
    monkeypatch.setattr(linking, "PART_NODES", 5)
    pick = random.Random(2)
    at = {n: pick.randrange(900) for n in range(200)}
    buckets = {b: pick.sample(range(200), pick.randint(2, 40)) for b in range(30)}
    got = run(spark, buckets, at)
    # All pairs of a bucket are found; others may be where buckets are searched together, but similar they are.
    must, may = plain(buckets, at), plain({0: list(got)}, at)
    assert got.keys() == must.keys() and len(set(got.values())) > 3
    assert all(got[n] == got[must[n]] and may[n] == may[got[n]] for n in got)


@pytest.mark.parametrize("size", [300, 1200])
def test_links_are_fewer_than_a_groups_nodes(spark, monkeypatch, size):
    """All alike, in two buckets, several parts: every search returns a forest of each part."""
    monkeypatch.setattr(linking, "PART_NODES", 100)
    counts = []
    real = linking._searched

    def counted(*args):
        links = real(*args)
        counts.append(links.count())
        return links

    monkeypatch.setattr(linking, "_searched", counted)
    at = {n: n % 4 for n in range(size)}
    got = run(spark, {1: list(at), 2: list(at)}, at)
    assert set(got.values()) == {0} and all(c < size for c in counts)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(60)] + [(100, 90), (200, 300), (300, 250)], "a bigint, b bigint")
    got = {r.node: r.component for r in linking.components(edges).collect()}
    assert got == {n: 0 for n in range(61)} | {90: 90, 100: 90, 200: 200, 250: 200, 300: 200}
    assert linking.components(edges.where(F.lit(False))).count() == 0
