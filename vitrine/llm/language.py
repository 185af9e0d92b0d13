"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is a bag of its one- to three-letter sequences, hashed into 65,536 places; words are lower-cased
and padded by a space. The matrix of log probabilities is sparse: a place's row names the languages that were seen
with it, and how much more likely it is with them than a place never seen, whose log probability is one number
per language. It goes to every task, and a batch is scored by looking up its sequences' rows and adding them up per
text.

Counting reads a sample of labelled texts spread by a hash of the id: about MAX_DOCS of each language, and of
more than SAMPLE_DOCS / MAX_DOCS languages SAMPLE_DOCS together, which bounds the matrix however many languages there are.

Defined results: a null text, or one without a letter, is `und` with score 0; without any labelled
text everything is; equally likely languages go to the first by code point; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from vitrine.llm.common import id_fold, table
from vitrine.llm.letters import letters, pieces_of, slices, with_columns

PLACES = 1 << 16
LONGEST = 3
MAX_DOCS = 5_000  # of each language, in the sample that is counted
SAMPLE_DOCS = 1_280_000  # of all languages together
SMOOTHING = 0.1
ENTRIES = 2_000_000  # of the matrix that are added up at once
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def places(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, text number) of every sequence, in parts that bound memory."""
    for group, at in slices(texts):
        points, number, letter = letters(group, at)
        if not len(points):
            continue
        word = np.cumsum(~letter) - ~letter
        hashed = np.zeros(len(points), np.uint64)
        found, owner = [], []
        for back in range(LONGEST):
            # The sequence of back + 1 signs that ends here, if it lies in one word and its padding.
            hashed = hashed[1:] if back else hashed
            shifted = points[: len(points) - back]
            hashed = (hashed + shifted) * _MIX[back]
            hashed ^= hashed >> np.uint64(31)
            same = word[back:] == word[: len(points) - back] if back else letter
            found.append((hashed >> np.uint64(24)).astype(np.int64)[same] & (PLACES - 1))
            owner.append(number[back:][same])
        yield np.concatenate(found), np.concatenate(owner)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    unseen: np.ndarray  # log probability of a place never seen, per language
    starts: np.ndarray  # of every place's entries, and their end
    seen: np.ndarray  # language of each entry
    gain: np.ndarray  # log probability over `unseen` of each entry

    def log_probability(self) -> np.ndarray:
        """The whole matrix, place × language."""
        out = np.repeat(self.unseen[None], PLACES, axis=0)
        out[np.repeat(np.arange(PLACES), np.diff(self.starts)), self.seen] += self.gain
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        many = len(self.languages)
        total = np.zeros(len(texts) * many)
        sequences = np.zeros(len(texts), np.int64)
        for place, owner in places(texts):
            sequences += np.bincount(owner, minlength=len(texts))
            held = np.diff(self.starts)[place]
            ends = np.cumsum(held)
            # Some places at a time, so that their entries fit.
            cuts = np.searchsorted(ends, np.arange(ENTRIES, ends[-1], ENTRIES)) if len(ends) else []
            for begin, end in zip([0, *cuts], [*cuts, len(place)]):
                some = held[begin:end]
                at = np.arange(some.sum()) + np.repeat(self.starts[place[begin:end]] - np.cumsum(some) + some, some)
                total += np.bincount(np.repeat(owner[begin:end] * many, some) + self.seen[at], self.gain[at], len(total))
        if not many:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total = total.reshape(len(texts), many) + sequences[:, None] * self.unseen + self.log_prior
        best = total.argmax(1)
        share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        known = sequences > 0
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, share, 0.0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in pieces_of(batches):
        lang = np.array(batch.column("lang").to_pylist())
        for place, owner in places(batch.column("text").to_pylist()):
            for one in np.unique(lang[np.unique(owner)]):
                held = counts.setdefault(str(one), np.zeros(PLACES, np.int64))
                held += np.bincount(place[lang[owner] == one], minlength=PLACES)
    for one, held in counts.items():
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([one] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(held[used])], ["lang", "place", "n"])


def fit(docs: DataFrame, max_docs: int = MAX_DOCS) -> LanguageModel:
    """The model of (doc_id, text, lang); rows of the held-out fold are never read."""
    labelled = docs.where((id_fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).collect()
    each = min(max_docs, max(1, SAMPLE_DOCS // max(1, len(sizes))))
    # A share per language as a constant: a join on the language would bring a whole language into one task.
    large = [x for r in sizes if r.docs > each for x in (r.lang, each / r.docs)]
    share = F.coalesce(F.create_map(*map(F.lit, large))[F.col("lang")], F.lit(1.0)) if large else F.lit(1.0)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)
    sample = labelled.where(drawn).select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, place int, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n")).toArrow()
    return matrix_of({r.lang: r.docs for r in sizes}, counts.column("lang").to_pylist(), counts.column("place").to_numpy(), counts.column("n").to_numpy())


def matrix_of(docs: dict[str, int], lang: list[str], place: np.ndarray, n: np.ndarray) -> LanguageModel:
    """The model of counts; languages of which no text had a letter are none."""
    languages = sorted(set(lang))
    number = {one: k for k, one in enumerate(languages)}
    seen = np.array([number[one] for one in lang], np.int64)
    total = np.bincount(seen, n, len(languages)) + SMOOTHING * PLACES
    order = np.lexsort((seen, place))
    seen, place, n = seen[order], place[order], n[order]
    starts = np.searchsorted(place, np.arange(PLACES + 1))
    prior = np.array([docs[one] for one in languages], float)
    unseen = np.log(SMOOTHING) - np.log(total)
    return LanguageModel(
        tuple(languages), np.log(prior) - np.log(max(prior.sum(), 1)), unseen, starts, seen.astype(np.int32),
        (np.log(n + SMOOTHING) - np.log(SMOOTHING)).astype(np.float32),
    )


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the most likely language and its probability among the known ones."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            names, share = sent.value.predict(batch.column(text).to_pylist())
            yield with_columns(batch, {lang: pa.array(names, pa.string()), score: pa.array(share, pa.float64())})

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(lang, StringType()), StructField(score, DoubleType())]))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "text", "lang"))
    held_out = id_fold(F.col("doc_id"), FOLDS) == HELD_OUT
    found = with_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
