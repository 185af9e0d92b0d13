"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary text.

Both predict a word's next letter from up to five letters before it in the word. A model's own counts
are discounted, and what they leave goes to a lower order that both models share: continuation counts
of shorter and shorter endings over all training text. So an expression that neither model has seen
says nothing, and a rare one says little.

A text is compared word by word: how much likelier is a word under the toxic model? The mean of these ratios over
the text's words is what counts, as a logarithm. So the difference is normalised by the text's length, and
ordinary texts have one near 0 however long they are, while a few words that are a thousand times likelier are not
lost among ordinary ones, as they would be in a sum of logarithms. The probability comes from a logistic curve,
fitted on texts that the counted half had not seen.

Counting and smoothing are Spark aggregations over a bounded sample of labelled texts, and every n-gram of
the sample is kept; what reaches the driver is one number and one value per n-gram and per context. Scoring
runs in array code over whole texts.

Defined results: texts without a letter have the difference 0; a document labelled both ways counts
as toxic; labels other than 0 and 1 are ignored; if one class has no text, every score is 0; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from vitrine.llm.common import id_fold, stored, table
from vitrine.llm.letters import SPACE, letters, pieces_of, slices, with_columns

ORDER = 6
DISCOUNT = 0.75
MAX_CHARS = 20_000_000  # about the characters of the sample per class and half of the training rows
MAX_DOCS = 25_000  # and its documents
FOLDS, HELD_OUT = 3, 1
REJECT = 0.7

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)


# --- n-grams as numbers --------------------------------------------------------------------


def _gram(context: np.ndarray, letter: np.ndarray) -> np.ndarray:
    z = (context ^ (letter * _MIX[0])) * _MIX[3]
    return z ^ (z >> np.uint64(31))


def _longer(context: np.ndarray, earlier: np.ndarray, back: int) -> np.ndarray:
    """The context with one more letter, the one `back` places before the predicted one."""
    h = context + (earlier + np.uint64(7)) * _MIX[back]
    return h ^ (h >> np.uint64(29))


class _Table:
    """Numbers to values by open addressing, for arrays of numbers at once."""

    PROBES = 16

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(len(keys) * 3 + 1))))
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.float32)
        left, values = keys, values.astype(np.float32)
        for probe in range(self.PROBES):
            seat = self._seat(left, probe)
            _, first = np.unique(seat, return_index=True)
            placed = np.zeros(len(left), bool)
            placed[first[self.keys[seat[first]] == 0]] = True
            self.keys[seat[placed]], self.values[seat[placed]] = left[placed], values[placed]
            left, values = left[~placed], values[~placed]
        self.probes = self.PROBES
        self.rest = dict(zip(left.tolist(), values.tolist()))

    def _seat(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((keys >> np.uint64(64 - self.bits)) + np.uint64(probe)) & np.uint64((1 << self.bits) - 1)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value or 0, whether there is one)"""
        seat = self._seat(keys, 0)
        held = self.keys[seat]
        found = held == keys
        out = np.where(found, self.values[seat], np.float32(0))
        going = np.flatnonzero(~found & (held != 0))
        for probe in range(1, self.probes):
            if not len(going):
                break
            seat = self._seat(keys[going], probe)
            held = self.keys[seat]
            hit = held == keys[going]
            out[going[hit]], found[going[hit]] = self.values[seat[hit]], True
            going = going[~hit & (held != 0)]
        if self.rest:
            for i in going:
                if (value := self.rest.get(int(keys[i]))) is not None:
                    out[i], found[i] = value, True
        return out, found


# --- the model -----------------------------------------------------------------------------


@dataclass(frozen=True)
class ToxicityModel:
    """Per n-gram, and per context of unseen n-grams, the toxic less the ordinary log probability."""

    grams: np.ndarray
    gram_values: np.ndarray
    contexts: np.ndarray
    context_values: np.ndarray
    slope: float = 0.0
    offset: float = -100.0

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.offset, -100, 100)))


class Scorer:
    def __init__(self, model: ToxicityModel):
        self.model = model
        self._grams = _Table(model.grams, model.gram_values)
        self._contexts = _Table(model.contexts, model.context_values)

    def differences(self, texts: list[str | None]) -> np.ndarray:
        """Per text the logarithm of the mean likelihood ratio of its words."""
        words, owners = [np.zeros(0)], [np.zeros(0, np.int64)]
        for group, at in slices(texts):
            points, number, letter = letters(group, at)
            if not len(points):
                continue
            ends = np.flatnonzero(~letter)
            word = np.cumsum(~letter) - ~letter
            start = np.concatenate([[0], ends[:-1] + 1])[word]
            place = np.arange(len(points)) - start
            context = np.zeros(len(points), np.uint64)
            for back in range(1, ORDER):
                earlier = np.full(len(points), SPACE, np.uint64)
                earlier[back:] = points[:-back]
                earlier[place < back] = SPACE
                context = _longer(context, earlier, back)
            value, seen = self._grams.get(_gram(context, points))
            unseen = np.flatnonzero(~seen)
            value[unseen] = self._contexts.get(context[unseen])[0]
            words.append(np.bincount(word, value, len(ends)))
            owners.append(number[ends])
        score, owner = np.concatenate(words), np.concatenate(owners)
        count = np.bincount(owner, minlength=len(texts))
        most = np.zeros(len(texts))
        np.maximum.at(most, owner, score)
        total = np.bincount(owner, np.exp(score - most[owner]), len(texts))
        return np.where(count > 0, most + np.log(np.maximum(total, 1e-300) / np.maximum(count, 1)), 0.0)


def logistic(difference: np.ndarray, toxic: np.ndarray, weight: np.ndarray, penalty: float = 0.02) -> tuple[float, float]:
    """Slope and offset of a curve through labelled differences that stand for `weight` rows each, by Newton's method."""
    x = np.stack([difference, np.ones(len(difference))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        gradient = x.T @ (weight * (toxic - p)) - penalty * beta
        hessian = (x * (weight * (p * (1 - p) + 1e-9))[:, None]).T @ x + penalty * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
    return float(beta[0]), float(beta[1])


def _gram_counts(sample: DataFrame) -> DataFrame:
    """gram, and its count per half and class, of the sample's words: (half, toxic, text) → gram, n00, n01, n10, n11."""
    words = (
        sample.select("half", "toxic", F.explode(F.expr(r"regexp_extract_all(lower(text), r'\p{L}+', 0)")).alias("word"))
        .groupBy("half", "toxic", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    padded = F.concat(F.lit(" " * (ORDER - 1)), F.col("word"), F.lit(" "))
    each = words.select("half", "toxic", "n", padded.alias("w"), F.explode(F.sequence(F.lit(1), F.char_length("word") + 1)).alias("i"))
    grams = each.select("half", "toxic", "n", F.col("w").substr(F.col("i"), F.lit(ORDER)).alias("gram"))
    pick = lambda half, toxic: F.sum(F.when((F.col("half") == half) & (F.col("toxic") == toxic), F.col("n")).otherwise(0))
    return grams.groupBy("gram").agg(*[pick(h, t).alias(f"n{h}{t}") for h in (0, 1) for t in (0, 1)])


# The counts of which halves make a model: each half's alone, to judge the other half's texts, and both.
PARTS = {"a": ("n00", "n01"), "b": ("n10", "n11"), "w": ("n00 + n10", "n01 + n11")}


def _smoothed(counts: DataFrame) -> DataFrame:
    """Per n-gram of `_gram_counts`: gram, and per model of PARTS its log ratio g<part> (null if the part lacks it)
    and, in one row of each context, the context's log ratio c<part>."""

    # level[k]: endings of k letters, and in how many of the endings one letter longer each occurs.
    seen = counts.select("gram", *[F.expr(f"int({o} + {t} > 0)").alias(f"k{p}") for p, (o, t) in PARTS.items()])
    level = {ORDER: stored(seen, "toxic-endings")}
    for size in range(ORDER - 1, 0, -1):
        longer = level[size + 1].select(F.expr(f"right(gram, {size})").alias("gram"), *[F.expr(f"int(k{p} > 0)").alias(f"k{p}") for p in PARTS])
        level[size] = stored(longer.groupBy("gram").agg(*[F.sum(f"k{p}").alias(f"k{p}") for p in PARTS]), "toxic-endings")
    letters_of = level[1].agg(*[F.count_if(F.col(f"k{p}") > 0).alias(p) for p in PARTS]).first()
    shared = None
    for size in range(1, ORDER):
        here = level[size].withColumn("context", F.expr(f"left(gram, {size - 1})"))
        sums = [x for p in PARTS for x in (F.sum(f"k{p}").alias(f"t{p}"), F.count_if(F.col(f"k{p}") > 0).alias(f"d{p}"))]
        here = here.join(here.groupBy("context").agg(*sums), "context").withColumn("lower", F.expr(f"right(gram, {size - 1})"))
        if shared is not None:
            here = here.join(shared.withColumnRenamed("gram", "lower"), "lower")
        value = {
            p: f"if(k{p} > 0, greatest(k{p} - {DISCOUNT}D, 0D) / t{p} + {DISCOUNT}D * d{p} / t{p} * "
            + (f"s{p}" if shared is not None else f"{1.0 / max(1, letters_of[p])!r}D") + ", NULL)"
            for p in PARTS
        }
        shared = stored(here.select("gram", *[F.expr(v).alias(f"s{p}") for p, v in value.items()]), "toxic-shared")
    classes = [(f"{p}{c}", PARTS[p][c]) for p in PARTS for c in (0, 1)]
    each = counts.select("gram", F.expr(f"left(gram, {ORDER - 1})").alias("context"), *[F.expr(n).alias(f"n{k}") for k, n in classes])
    sums = [x for k, _ in classes for x in (F.sum(f"n{k}").alias(f"t{k}"), F.count_if(F.col(f"n{k}") > 0).alias(f"d{k}"))]
    contexts = each.groupBy("context").agg(F.min("gram").alias("first"), *sums)
    left = lambda k: f"if(t{k} > 0, {DISCOUNT}D * d{k} / t{k}, 1D)"
    whole = (
        each.join(contexts, "context")
        .withColumn("lower", F.expr(f"right(gram, {ORDER - 1})"))
        .join(shared.withColumnRenamed("gram", "lower"), "lower")
    )
    prob = lambda k, p: f"greatest(n{k} - {DISCOUNT}D, 0D) / greatest(t{k}, 1) + {left(k)} * s{p}"
    grams = [
        F.expr(f"if(n{p}0 + n{p}1 > 0, float(ln({prob(p + '1', p)}) - ln({prob(p + '0', p)})), NULL)").alias(f"g{p}") for p in PARTS
    ]
    own = [
        F.expr(f"if(gram = first AND t{p}0 + t{p}1 > 0, float(ln({left(p + '1')}) - ln({left(p + '0')})), NULL)").alias(f"c{p}") for p in PARTS
    ]
    return whole.select("gram", *grams, *own)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams as the numbers that texts are looked up by: gram, context, and the values."""
    for batch in batches:
        points = np.frombuffer("".join(batch.column("gram").to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, ORDER).astype(np.uint64)
        context = np.zeros(len(points), np.uint64)
        for back in range(1, ORDER):
            context = _longer(context, points[:, ORDER - 1 - back], back)
        numbers = [pa.array(x.view(np.int64)) for x in (_gram(context, points[:, -1]), context)]
        yield pa.RecordBatch.from_arrays([*numbers, *batch.columns[1:]], ["gram", "context", *batch.schema.names[1:]])


def _models(counts: DataFrame) -> dict[str, ToxicityModel]:
    """The model of each of PARTS."""
    names = [f"{k}{p}" for k in "gc" for p in PARTS]
    schema = "gram bigint, context bigint, " + ", ".join(f"{n} float" for n in names)
    smoothed = stored(_smoothed(counts).mapInArrow(_numbered, schema), "toxic-model")

    def column(key: str, name: str) -> tuple[np.ndarray, np.ndarray]:
        rows = smoothed.where(F.col(name).isNotNull()).select(key, name).toArrow()
        return rows.column(key).to_numpy().view(np.uint64), rows.column(name).to_numpy()

    return {p: ToxicityModel(*column("gram", f"g{p}"), *column("context", f"c{p}")) for p in PARTS}


def _sample(docs: DataFrame, labels: DataFrame, max_chars: int, max_docs: int) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """doc_id, text, toxic, half of a sample spread by a hash of the id, at most about the bounds per class and half;
    and the rows of the whole table per (half, toxic).

    Ids are drawn on a table without texts; the bound on their number is what lets them go to every task,
    so that no text is shuffled.
    """
    known = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    fold = id_fold(F.col("doc_id"), FOLDS)
    half = F.when(fold == 0, 0).otherwise(1).alias("half")
    rows = docs.where((fold != HELD_OUT) & F.col("text").isNotNull()).select("doc_id", "text", half)
    slim = rows.select("doc_id", "half", F.char_length("text").alias("chars"))
    labelled = stored(slim.join(known, "doc_id"), "toxic-labelled")
    sizes = labelled.groupBy("half", "toxic").agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("docs")).collect()
    share = F.lit(0.0)
    for r in sizes:  # two halves of two classes
        own = min(1.0, max_chars / max(1, r.chars), max_docs / r.docs)
        share = F.when((F.col("half") == r.half) & (F.col("toxic") == r.toxic), own).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)
    ids = labelled.where(drawn).select("doc_id", "toxic").distinct()
    sample = rows.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic", "half")
    return sample, {(r.half, r.toxic): r.docs for r in sizes}


def fit(docs: DataFrame, labels: DataFrame, max_chars: int = MAX_CHARS, max_docs: int = MAX_DOCS) -> ToxicityModel:
    """The model of (doc_id, text) and (doc_id, toxic); rows of the held-out fold are never read."""
    drawn, sizes = _sample(docs, labels, max_chars, max_docs)
    sample = stored(drawn, "toxic-sample")
    counts = stored(_gram_counts(sample), "toxic-grams")
    some = counts.agg(F.sum(F.col("n00") + F.col("n10")).alias("ordinary"), F.sum(F.col("n01") + F.col("n11")).alias("toxic")).first()
    if not some.ordinary or not some.toxic:
        return ToxicityModel(*(np.zeros(0, t) for t in (np.uint64, np.float32, np.uint64, np.float32)))
    models = _models(counts)
    whole = models.pop("w")
    # Each half's texts are judged by the other half's counts.
    halves = [models.pop("a"), models.pop("b")]
    sent = sample.sparkSession.sparkContext.broadcast(halves)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(m) for m in sent.value]
        for batch in pieces_of(batches):
            half = batch.column("half").to_numpy()
            texts = batch.column("text").to_pylist()
            both = np.stack([s.differences(texts) for s in scorers])
            found = pa.array(both[1 - half, np.arange(len(half))])
            yield pa.RecordBatch.from_arrays([found, batch.column("toxic"), batch.column("half")], ["difference", "toxic", "half"])

    judged = sample.select("text", "toxic", "half").mapInArrow(judge, "difference double, toxic int, half int")
    # A curve needs no single rows: differences in steps of a hundredth, with their number.
    steps = judged.groupBy(F.round("difference", 2).alias("d"), "half", "toxic").agg(F.count(F.lit(1)).alias("n")).toPandas()
    sent.destroy()
    del halves
    # A class is thinned by its own share: each judged row stands for as many rows of the table as were left out for it.
    groups = list(zip(steps["half"], steps["toxic"]))
    judged_rows = steps.groupby(["half", "toxic"])["n"].sum()
    weight = steps["n"].to_numpy() * np.array([sizes[g] / judged_rows[g] for g in groups])
    slope, offset = logistic(steps["d"].to_numpy(), steps["toxic"].to_numpy().astype(float), weight)
    return ToxicityModel(whole.grams, whole.gram_values, whole.contexts, whole.context_values, slope, offset)


def with_scores(docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """`docs` with the probability of label 1 in a column `score`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in pieces_of(batches):
            found = scorer.differences(batch.column(text).to_pylist())
            yield with_columns(batch, {score: pa.array(sent.value.probability(found), pa.float64())})

    schema = StructType([*docs.schema.fields, StructField(score, DoubleType())])
    return docs.mapInArrow(run, schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held_out = id_fold(F.col("doc_id"), FOLDS) == HELD_OUT
    return with_scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, all columns as they were."""
    model = fit(docs.select("doc_id", "text"), labels)
    scored = with_scores(docs, model, score="__toxicity")
    return scored.where(F.col("__toxicity") < REJECT).select(*[F.col(f"`{c}`") for c in docs.columns])
