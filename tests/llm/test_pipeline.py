import hashlib
import random
import re
from collections import Counter

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import docs_of, sentences
from test_mixing import filled, size_of
from test_near_dedup import changed, plain as near_classes
from test_toxicity import BAD, table_of
from vitrine.llm import pieces, toxicity
from vitrine.llm.common import stored

BASE = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    pick = random.Random(17)
    lines = sentences(31, 40)
    rows = []
    for i in range(240):
        text = " ".join(pick.sample(lines, 2)).split()
        if i % 6 == 0:
            for _ in range(3):
                text.insert(pick.randrange(len(text)), pick.choice(BAD))
        rows.append((i, " ".join(text), ["a", "b", "c", None][i % 4]))
    rows += [(300 + n, rows[n][1].upper() if n % 2 else rows[n][1], "b") for n in range(1, 40, 2)]
    rows += [(400 + n, changed(rows[n][1], 0.01, pick), "a") for n in range(1, 60, 3)]
    rows += [(500, None, "a"), (501, "", "b"), (502, "42", "c"), (503, "tiny", None), (503, "tiny", None), (None, "no id", "a")]
    return rows, {i: int(any(b in (t or "") for b in BAD)) for i, t, _ in rows if i is not None and i < 240}


def stages_by_hand(rows, rejected):
    rows = [r for r in rows if r[1] not in rejected]
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    kept = {}
    for r in rows:
        if lower(r[1]) not in kept or (r[0] is not None and (kept[lower(r[1])][0] is None or kept[lower(r[1])][0] < r[0])):
            kept[lower(r[1])] = r
    rows = list(kept.values())
    classes = {i: c for i, c, _ in near_classes([r[:2] for r in rows])}
    rows = [r for r in rows if r[0] is None or classes[r[0]] == r[0]]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size_of(t)
    targets, out = filled(dict(sizes)), Counter()
    for source in sizes:
        at, budget = 0, int(targets[source] + 1e-9)
        for i, t, _ in sorted((r for r in rows if r[2] == source), key=lambda r: hashlib.md5(b"" if r[0] is None else str(r[0]).encode()).hexdigest()):
            size = size_of(t)
            if size:
                taken = budget // sizes[source] * size + max(0, min(size, budget % sizes[source] - at))
                out[(i, t)] += (taken + size // 2) // size
            at += size
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    return sorted(str((i, library.encode(t))) for (i, t), n in out.items() for _ in range(n))


def test_rows_are_those_of_a_plain_version(spark, tmp_path):
    rows, labels = corpus()
    docs_of(spark, rows).select(*BASE).write.parquet(f"{tmp_path}/documents.parquet")
    table_of(spark, labels).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scored = toxicity.with_scores(docs, toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")))
    rejected = {r.text for r in scored.where(F.col("score") >= toxicity.REJECT).collect()}
    toxic = {t for i, t, _ in rows if labels.get(i)}
    clean = {t for i, t, _ in rows if labels.get(i) == 0}
    assert len(toxic & rejected) >= 0.95 * len(toxic) and len(clean & rejected) <= 0.02 * len(clean)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str((r.doc_id, r.ids)) for r in out) == stages_by_hand(rows, rejected)


def test_stages_keep_the_columns_and_take_extra_ones(spark, tmp_path):
    rows, labels = corpus()
    table_of(spark, labels).write.parquet(f"{tmp_path}/labels.parquet")
    for some in (rows[:30] + rows[-6:], []):
        docs = docs_of(spark, some)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), "stage-test")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == columns
        assert bool(some) == (docs.count() > 0)
