"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Both tokenizers encode a text to tokens whose bytes, joined, are the same; the byte offsets where tokens of
both end cut them into groups, and all pairs of a group are links. A batch is aligned in lockstep: one vector
holds a pointer into the A tokens and one into the B tokens of every lane. In each step all lanes compare
the ends they point at; the pointer whose token ends earlier moves on, both where the ends are equal, which is a cut
and closes the lane's group. Lanes that have come to their end leave the vectors. A lane is a text or a stretch
of one: every LANE-th A token that ends where a B token ends starts a new lane, so long texts don't keep a batch waiting.

A pair's count is the number of documents that hold it. The tasks count before the shuffle; the commonest
pairs, HEAD_PAIRS at most, go to all tasks as two arrays, as every document has some of them; the documents' other
pairs are joined with their counts. Both ways run at any size.

Defined results: null and empty texts, and those whose tokens don't give their bytes again (as with U+2581 in
the text), have no tokens: zeros and an empty digest; special tokens' strings in a text are plain text; every row
is a document, also where an id comes again or is null; an empty table gives an empty table; no other column is read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitrine.llm.common import stored, table
from vitrine.llm.pieces import SPACE, PieceModel

A_PATH, B_PATH = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
BATCH_CHARS = 1_000_000  # of texts that are aligned together; a longer text is a batch
LANE = 256  # A tokens, about
KNOWN_WORDS, LONGEST_KNOWN = 200_000, 40  # words that are remembered, and their characters
HEAD_PAIRS = 1_000_000
TASK_PAIRS = 2_000_000  # counted in a task before they are handed on
GROUP_PAIRS = 4_096  # a group of more links is paired by different ids

# Fixed value: how a byte-level vocabulary of this kind splits a text before it merges bytes.
_A_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


# --- texts to tokens -----------------------------------------------------------------------


class TokenizerA:
    """A byte-level vocabulary: encodes the text with a space before it.

    If its numbers are the ranks of its merges, which is checked, a text is merged by ranks; otherwise by the list of merges.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored_form = json.load(file)
        special = {token["content"] for token in stored_form["added_tokens"]}
        vocabulary, merges = stored_form["model"]["vocab"], stored_form["model"]["merges"]
        # Bytes that print stand for themselves, the others for the characters from 256 up, in order.
        printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = sorted(set(range(256)) - set(printing))
        byte_of = {chr(b): b for b in printing} | {chr(256 + n): b for n, b in enumerate(others)}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            self.bytes[number] = entry.encode() if entry in special else bytes(byte_of[c] for c in entry)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        if [vocabulary.get(m) for m in joined] == list(range(256, 256 + len(joined))):
            ranks = {self.bytes[number]: number for entry, number in vocabulary.items() if entry not in special}
            self._ids = tiktoken.Encoding(os.path.basename(path), pat_str=_A_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self._ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        return self._ids(" " + text)


class TokenizerB:
    """A piece vocabulary, which puts the space before the text itself.

    No piece goes on from one word into the next (see `PieceModel.words`), so words are encoded one by one by the
    library and remembered, up to a bound.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.model = PieceModel(file.read())
        byte_of = self.model.byte_of
        self.bytes = [bytes([byte_of[n]]) if n in byte_of else p.replace(SPACE, " ").encode() for n, p in enumerate(self.model.pieces)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        encode = sentencepiece.SentencePieceProcessor(model_file=path).encode_as_ids
        before = encode("\n")  # a space and the \n, over which no piece goes either

        class Words(dict):
            def __missing__(self, word: str) -> list[int]:
                if word == SPACE:
                    ids = before[:1]
                elif word[0] == SPACE:
                    ids = encode(word[1:].replace(SPACE, " "))
                else:
                    ids = encode("\n" + word)[len(before) :]
                if len(self) >= KNOWN_WORDS:
                    self.clear()
                if len(word) <= LONGEST_KNOWN:
                    self[word] = ids
                return ids

        self._word = Words().__getitem__

    def ids(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._word, self.model.words.findall(SPACE + text.replace(" ", SPACE)))))


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> tuple[TokenizerA, TokenizerB]:
    """One pair per worker; the paths are vocabulary files that every machine has."""
    return TokenizerA(a_path), TokenizerB(b_path)


# --- alignment -----------------------------------------------------------------------------


def cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of all cuts, in order: tokens that end at the same byte.

    `a_ends` and `b_ends` are the ascending end offsets of all tokens, text after text; `a_first` and `b_first`
    the first token of every text, which has at least one.
    """
    # Lanes: the texts, and stretches from known cuts on.
    tried = np.arange(LANE - 1, len(a_ends), LANE)
    match = np.searchsorted(b_ends, a_ends[tried])
    cut = b_ends[np.minimum(match, len(b_ends) - 1)] == a_ends[tried]
    a = np.unique(np.concatenate([a_first, tried[cut] + 1]))
    b = np.unique(np.concatenate([b_first, match[cut] + 1]))
    a, b = a[a < len(a_ends)], b[b < len(b_ends)]
    stop = np.append(a[1:], len(a_ends))
    found_a, found_b = [], []
    while len(a):
        end_a, end_b = a_ends[a], b_ends[b]
        equal = end_a == end_b
        found_a.append(a[equal])
        found_b.append(b[equal])
        forward = end_a <= end_b
        b = b + (end_b <= end_a)
        a = a + forward
        alive = a < stop
        if not alive.all():  # a lane ends with a cut
            a, b, stop = a[alive], b[alive], stop[alive]
    none = np.zeros(0, np.int64)
    return np.sort(np.concatenate(found_a or [none])), np.sort(np.concatenate(found_b or [none]))


def links(a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, how often) of the different pairs of every text; a pair is A id * width + B id.

    `text` is the ascending text number of every group.
    """
    a_size, b_size = np.diff(a_cut, prepend=-1), np.diff(b_cut, prepend=-1)
    a_from, b_from = a_cut + 1 - a_size, b_cut + 1 - b_size
    many = a_size * b_size
    plain = np.flatnonzero(many <= GROUP_PAIRS)
    group = np.repeat(plain, many[plain])
    nth = np.arange(len(group)) - np.repeat(np.cumsum(many[plain]) - many[plain], many[plain])
    row = nth // b_size[group]
    pair = a[a_from[group] + row].astype(np.int64) * width + b[b_from[group] + nth - row * b_size[group]]
    texts, pairs, times = [text[group]], [pair], [np.ones(len(pair), np.int64)]
    for one in np.flatnonzero(many > GROUP_PAIRS):
        some_a, times_a = np.unique(a[a_from[one] : a_cut[one] + 1], return_counts=True)
        some_b, times_b = np.unique(b[b_from[one] : b_cut[one] + 1], return_counts=True)
        pairs.append((some_a[:, None].astype(np.int64) * width + some_b).ravel())
        times.append((times_a[:, None] * times_b).ravel())
        texts.append(np.full(len(pairs[-1]), text[one]))
    texts, pairs, times = (np.concatenate(x) for x in (texts, pairs, times))
    order = np.lexsort((pairs, texts)) if len(plain) < len(many) else np.argsort(texts * (int(pairs.max(initial=0)) + 1) + pairs)
    texts, pairs, times = texts[order], pairs[order], times[order]
    new = np.ones(len(texts), bool)
    new[1:] = (texts[1:] != texts[:-1]) | (pairs[1:] != pairs[:-1])
    starts = np.flatnonzero(new)
    return texts[starts], pairs[starts], np.add.reduceat(times, starts) if len(starts) else times


class Groups:
    """The text form of groups: `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, n_a: int, n_b: int):
        self._n_a = n_a
        self._words = [f";{n}" for n in range(n_a)] + [f",{n}" for n in range(n_a)] + [f"|{n}" for n in range(n_b)] + [f",{n}" for n in range(n_b)]
        self._n_b = n_b

    def texts(self, a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, ends: np.ndarray) -> list[str]:
        """`ends`: per text the number of groups up to its end."""
        inner_a, inner_b = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
        a_size, b_size = np.diff(a_cut, prepend=-1), np.diff(b_cut, prepend=-1)
        inner_a[a_cut + 1 - a_size] = inner_b[b_cut + 1 - b_size] = 0
        out = np.empty(len(a) + len(b), np.int64)
        # A group's A tokens come after the B tokens of the groups before it, its B tokens after its own A tokens.
        out[np.arange(len(a)) + np.repeat(b_cut + 1 - b_size, a_size)] = a + inner_a * self._n_a
        out[np.arange(len(b)) + np.repeat(a_cut + 1, b_size)] = b + inner_b * self._n_b + 2 * self._n_a
        words = self._words
        stops = np.concatenate([[0], a_cut + b_cut + 2])[ends].tolist()
        codes = out.tolist()
        return ["".join([words[c] for c in codes[start:stop]])[1:] for start, stop in zip([0, *stops], stops)]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Rows whose texts are aligned together: their numbers and texts."""
    rows, texts, size = [], [], 0
    for batch in batches:
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
            one = text.as_py() or ""
            rows.append(row)
            texts.append(one)
            size += len(one)
            if size >= BATCH_CHARS:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def aligned_texts(texts: list[str], a_path: str = A_PATH, b_path: str = B_PATH) -> dict[str, np.ndarray | list]:
    """Per text n_a, n_b, n_groups, form; and its different pairs: a list's end, pairs, times."""
    first, second = tokenizers(a_path, b_path)
    ids = ([], [])
    good = np.zeros(len(texts), bool)
    for number, text in enumerate(texts):
        own = [side.ids(text) for side in (first, second)] if text else []
        exact = (" " + text).encode()
        good[number] = bool(own) and all(b"".join(map(side.bytes.__getitem__, x)) == exact for side, x in zip((first, second), own))
        for all_ids, x in zip(ids, own if good[number] else ([], [])):
            all_ids.append(x)
    n_a, n_b = (np.fromiter(map(len, x), np.int64, len(texts)) for x in ids)
    a, b = (np.fromiter(chain.from_iterable(x), np.int32, n.sum()) for x, n in zip(ids, (n_a, n_b)))
    some = np.flatnonzero(good)
    a_cut, b_cut = cuts(
        np.cumsum(first.lengths[a]), np.cumsum(second.lengths[b]), (np.cumsum(n_a) - n_a)[some], (np.cumsum(n_b) - n_b)[some]
    )
    text = np.searchsorted(np.cumsum(n_a), a_cut, "right")  # of every group
    n_groups = np.bincount(text, minlength=len(texts))
    of, pair, times = links(a, b, a_cut, b_cut, text, len(second.bytes))
    forms = _groups(len(first.bytes), len(second.bytes)).texts(a, b, a_cut, b_cut, np.cumsum(n_groups))
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "form": forms, "pairs_end": np.searchsorted(of, np.arange(len(texts)), "right"), "pair": pair, "times": times}


@lru_cache(maxsize=2)
def _groups(n_a: int, n_b: int) -> Groups:
    return Groups(n_a, n_b)


def _align(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _batches(batches):
            found = aligned_texts(texts, a_path, b_path)
            offsets = pa.array(np.concatenate([[0], found["pairs_end"]]), pa.int32())
            width = len(tokenizers(a_path, b_path)[1].bytes)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (found["pair"] // width, found["pair"] % width, found["times"])]
            digests = [hashlib.sha256(f.encode()).hexdigest() if f else "" for f in found["form"]]
            total = np.add.reduceat(np.append(found["times"], 0), np.concatenate([[0], found["pairs_end"][:-1]])) if len(texts) else np.zeros(0)
            empty = np.diff(found["pairs_end"], prepend=0) == 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), *(pa.array(x, pa.int64()) for x in (found["n_a"], found["n_b"], found["n_groups"], np.where(empty, 0, total))), pa.array(digests, pa.string()), *lists],
                ["row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "times"],
            )

    return run


# --- counts --------------------------------------------------------------------------------


def _merge(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    pair, at = np.unique(np.concatenate(pairs), return_inverse=True)
    return pair, np.bincount(at, np.concatenate(counts), len(pair)).astype(np.int64)


def _pairs_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("a").flatten().to_numpy().astype(np.int64) * width + batch.column("b").flatten().to_numpy()


def _count(width: int):
    """Pairs and the documents of a task that hold them; a document has a pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(counts[0])], ["pair", "n"])

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                found = _pairs_of(batch.slice(start, 512), width)
                pairs.append(found)
                counts.append(np.ones(len(found), np.int64))
                held += len(found)
                if held > TASK_PAIRS:
                    merged = _merge(pairs, counts)
                    pairs, counts = [merged[0]], [merged[1]]
                    held = len(merged[0])
                    if held > TASK_PAIRS // 2:
                        yield done()
                        pairs, counts, held = [], [], 0
        if pairs:
            merged = _merge(pairs, counts)
            pairs, counts = [merged[0]], [merged[1]]
            yield done()

    return run


def _score(head, width: int):
    """What the head's pairs add to every document, and its other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = head.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                some = batch.slice(start, 512)
                pair, times = _pairs_of(some, width), some.column("times").flatten().to_numpy().astype(np.int64)
                row = np.repeat(np.arange(some.num_rows), np.diff(some.column("a").offsets.to_numpy()))
                at = np.searchsorted(known, pair)
                at[at == len(known)] = 0
                met = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                at, of, own = at[met], row[met], times[met]
                sums, bests = np.zeros(some.num_rows, np.int64), np.zeros(some.num_rows, np.int64)
                np.add.at(sums, of, count[at] * own)
                np.add.at(bests, of, best[at] * own)
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~met], minlength=some.num_rows))]), pa.int32())
                rest = [pa.ListArray.from_arrays(offsets, pa.array(x[~met])) for x in (pair, times)]
                yield pa.RecordBatch.from_arrays([some.column("row"), pa.array(bests), pa.array(sums), *rest], ["row", "n_best", "count_sum", "pair", "times"])

    return run


def _head(counted: DataFrame, most: int) -> tuple[int, DataFrame]:
    """The least count of the head, and its pairs: the commonest, at most `most`."""
    step = F.floor(F.log2("n") * 8)  # counts by eighths of a power of two
    sizes = counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    least, held = None, 0
    for one in sizes:
        held += one.pairs
        if held > most:
            break
        least = one.least
    return (least, counted.where(F.col("n") >= least)) if least is not None else (0, counted.limit(0))


def aligned(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, doc_id: str = "doc_id", text: str = "text", head_pairs: int = HEAD_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(a row per row of `docs` with its alignment and its scores; all pairs with their counts).

    On the driver are the head's pairs and counts, two arrays of at most `head_pairs` numbers, and one number per A id.
    """
    spark = docs.sparkSession
    width = len(tokenizers(a_path, b_path)[1].bytes)
    rows = stored(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).withColumn("row", F.monotonically_increasing_id()), "rows-to-align")
    schema = "row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, a array<int>, b array<int>, times array<int>"
    found = stored(rows.select("row", "text").mapInArrow(_align(a_path, b_path), schema), "aligned")
    per_task = found.select("a", "b").mapInArrow(_count(width), "pair bigint, n bigint")
    totals = per_task.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.floor(F.col("pair") / width).cast("int"))
    counted = stored(totals, "pair-counts")
    highest = counted.groupBy("a").agg(F.max("n").alias("highest"))
    least, head = _head(counted, head_pairs)
    best = {r.a: r.highest for r in highest.collect()}  # by the A vocabulary
    pairs = sorted((r.pair, r.n) for r in head.select("pair", "n").toLocalIterator())
    known, count = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    tops = np.zeros(1 + max(best, default=0), np.int64)
    tops[list(best)] = list(best.values())
    sent = spark.sparkContext.broadcast((known, count, count == tops[known // width]))
    scored = found.select("row", "a", "b", "times").mapInArrow(_score(sent, width), "row bigint, n_best bigint, count_sum bigint, pair array<bigint>, times array<bigint>")
    scored = stored(scored, "pair-scores")
    tail = counted.where(F.col("n") < least) if least else counted
    tail = tail.join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).cast("bigint").alias("top"))
    each = scored.select("row", F.explode(F.arrays_zip("pair", "times")).alias("p")).select("row", "p.pair", "p.times")
    more = each.join(tail, "pair").groupBy("row").agg(F.sum(F.col("top") * F.col("times")).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    whole = rows.select("row", "doc_id").join(found.drop("a", "b", "times"), "row").join(scored.select("row", "n_best", "count_sum"), "row").join(more, "row", "left")
    out = whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
    return out, counted.select("a", (F.col("pair") % width).cast("int").alias("b"), "n")


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's alignment of the two tokenizers, scored by all documents' pairs."""
    return aligned(table(spark, sf_dir, "documents"))[0]
