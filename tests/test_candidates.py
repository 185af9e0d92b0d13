import gzip

import pytest

from vitrine.operators import candidates as cand
from vitrine.sources import crawl, seeds

SEED = "source_name string, source_value string, seq bigint"


def test_import_counts_new_keys_and_valid_rows(spark):
    first = spark.createDataFrame(
        [("a", "https://www.lotus.in/x", 0), ("a", "http://lotus.in/other", 1), ("a", "https://shop.lotus.in/p", 2), ("a", "localhost", 3)], SEED)
    known = cand.clean_candidates(first)
    rows = {r.candidate_key: r for r in known.collect()}
    assert set(rows) == {"https://lotus.in", "https://shop.lotus.in"}
    assert rows["https://shop.lotus.in"].registrable_domain == "lotus.in" and rows["https://lotus.in"].discovered_seq == 0
    assert [(r.added, r.eligible) for r in cand.import_counters(first).collect()] == [(2, 3)]
    again = spark.createDataFrame([("b", "https://lotus.in/new", 9)], SEED)
    assert cand.clean_candidates(again, known).count() == 0
    assert [(r.added, r.eligible) for r in cand.import_counters(again, known).collect()] == [(0, 1)]
    triples = cand.candidate_sources(again, cand.candidate_sources(first))
    names = {tuple(r.source_names) for r in cand.source_names(triples).collect()}
    assert names == {("a", "b"), ("a",)}


def test_pending_by_source_and_limit(spark):
    df = spark.createDataFrame(
        [(1, "https://first.in", "first.in", "pending", 0, 5, None), (2, "https://second.in", "second.in", "retry", 1, 3, "x"),
         (3, "https://third.in", "third.in", "accepted", 1, 1, None)],
        "candidate_id bigint, candidate_key string, registrable_domain string, status string, attempts int, discovered_seq bigint, last_error string")
    sources = spark.createDataFrame([(1, "a", "v"), (2, "b", "v"), (2, "b", "w"), (3, "b", "v")], "candidate_id bigint, source_name string, source_value string")
    assert [r.candidate_key for r in cand.pending_candidates(df, sources, "b").collect()] == ["https://second.in"]
    assert [r.candidate_id for r in cand.pending_candidates(df, limit=1).collect()] == [2]


@pytest.mark.parametrize("text, expected", [
    ("name,Website\nx,a.in\ny,b.in\n", ["a.in", "b.in"]),
    ("﻿url,domain\nu1.in,d1.in\n", ["d1.in"]),
    ("Domain_URL\na.in\n\n  \nb.in\n", ["a.in", "b.in"]),
    ("a.in,1\nb.in,2\n", ["a.in", "b.in"]),
    ("id,url\n1,a.in\n2\n3,\"b.in, c\"\n", ["a.in", "b.in, c"]),
])
def test_csv_header_sniffing(spark, tmp_path, text, expected):
    path = tmp_path / "seeds.csv"
    path.write_text(text, encoding="utf-8")
    got = seeds.read_seeds(spark, str(path)).orderBy("seq").collect()
    assert [r.source_value.strip() for r in got] == expected and got[0].source_name == "file:seeds.csv"


def test_text_seeds(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("﻿a.in\n\n # note\n#x\n  b.in \n", encoding="utf-8")
    assert [r.source_value for r in seeds.read_seeds(spark, str(path), "list").orderBy("seq").collect()] == ["a.in", "b.in"]


def test_master_list(spark, tmp_path):
    path = tmp_path / "master.csv.gz"
    with gzip.open(path, "wt", encoding="utf-8") as handle:
        handle.write("domain,platform,technologies\nA.in,Shopify,\nb.com,Shopify,\nc.co.in,,\"x, SHOPIFY\"\nd.in,Magento\n")
    rows = seeds.read_master_list(spark, str(path))
    assert sorted(r.source_value for r in cand.master_seeds(rows).collect()) == ["A.in", "c.co.in"]


def test_crawl_sources(spark, tmp_path):
    (tmp_path / "pages.json").write_text('{"store_id": 1, "page_seq": 0, "headers": {"x-shopid": "1"}, "body": "b"}\nbroken{\n')
    assert [r.headers for r in crawl.read_pages_json(spark, str(tmp_path / "pages.json")).collect()] == [{"x-shopid": "1"}]
    (tmp_path / "captures.txt").write_text('{"url":"u","timestamp":"2024","status":"200","digest":"A"}\noops\n{"url":"w","status":"404"}\n')
    assert [r.url for r in crawl.read_captures(spark, str(tmp_path / "captures.txt")).collect()] == ["u", "w"]
    assert [r.url for r in crawl.read_captures(spark, str(tmp_path / "captures.txt"), 2).collect()] == ["u"]


def test_seeds_are_numbered_in_file_order(spark, tmp_path):
    folder = tmp_path / "lists"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join(f"a{n}.in" for n in range(3)))
    (folder / "b.txt").write_text("\n".join(f"b{n}.in" for n in range(2000)))
    got = [r.source_value for r in seeds.read_text_seeds(spark, str(folder)).orderBy("seq").collect()]
    assert got == [f"a{n}.in" for n in range(3)] + [f"b{n}.in" for n in range(2000)]


def test_every_csv_file_has_its_own_header(spark, tmp_path):
    folder = tmp_path / "lists.csv"
    folder.mkdir()
    (folder / "a").write_text('"name, legal",url\n"x, y",a.in\n')
    (folder / "b").write_text('Website,id\nb.in,"1,2"\n')
    (folder / "c").write_text("c.in,7\nurl,8\n")
    got = [r.source_value for r in seeds.read_seeds(spark, str(folder)).orderBy("seq").collect()]
    assert got == ["a.in", "b.in", "c.in", "url"]
