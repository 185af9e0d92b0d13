"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text runs through the search character by character. For every position the best last piece that
ends there is kept, with a pointer back to where it starts; only as many positions as the longest
piece has characters can still be pointed at. As soon as the pointer paths from all of them meet in
one boundary, the ids before it are final and leave the window, so memory does not grow with the
text.

What makes a piece the best one depends on the model. A unigram model adds up piece scores. In a
merge model (BPE) scores are ranks of merges and adding them up would give other ids; there a piece
survives at a position if merging would really end in it: two pieces may stand side by side exactly
if merging their joined text gives these two again. A path of such neighbours is what merging the
whole text yields, and there is one for every position, so the ids are those of the library.

Defined results: a null or empty text has no ids; characters outside the vocabulary become byte
pieces, or the unknown id in a model without them; the white space mark U+2581 in a text decodes to a
space, as in the library; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in a model file
UNKNOWN_PENALTY = 10.0  # below the lowest score, as the library has it

CACHED_WORDS = 300_000  # remembered words, and as many of the time before
MOST_NEIGHBOURS = 1_000_000
LONGEST_CACHED = 64
CHECK_EVERY = 32  # positions between two looks for a common boundary


# --- the model file ------------------------------------------------------------------------


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a serialised message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class PieceModel:
    """Pieces, their ids and scores, and the settings that matter for encoding."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer, normalizer = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        self.type = trainer.get(3, UNIGRAM)
        if self.type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and merge models are supported")
        if normalizer.get(2) or normalizer.get(4, 1):
            raise ValueError("models that rewrite the text or its white space are not supported")
        self.prefix = bool(normalizer.get(3, 1))
        self.score = {p: s for p, s, k in zip(self.pieces, scores, self.kinds) if k in (NORMAL, USER)}
        self.id = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, USER)}
        self.unknown = self.kinds.index(UNKNOWN)
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.longest = max(map(len, self.id))
        self.lowest = min(self.score.values())
        self.automaton = ahocorasick.Automaton()
        for piece, number in self.id.items():
            self.automaton.add_word(piece, (number, len(piece)))
        self.automaton.make_automaton()
        # No piece goes on over these, so every path has a boundary before them.
        inside = any(SPACE in p[1:] and p.strip(SPACE) for p in self.id)
        breaks = "".join(c for c in "\n\t\r" if not any(c in p for p in self.id))
        word = f"{SPACE}*[^{SPACE}{breaks}]+|{SPACE}+" + (f"|[{breaks}]" if breaks else "")
        self.words = re.compile("(?s:.+)" if inside else word)

    def ids_outside(self, character: str) -> list[int]:
        """The ids of a character that no piece holds."""
        return [self.byte_id[b] for b in character.encode()] if self.byte_id else [self.unknown]


# --- the search ----------------------------------------------------------------------------


PAIR = 1 << 32  # keeps two ids in one number
OUTSIDE, NOTHING = -1, -2  # in place of a piece: a character outside the vocabulary, the start of the text


class StreamingViterbi:
    """Feed it characters; it returns ids as soon as they are final."""

    def __init__(self, model: PieceModel, neighbours: dict[int, bool] | None = None):
        """neighbours: what is known of pairs of pieces, shared between searches."""
        self.model, self._neighbours = model, {} if neighbours is None else neighbours
        self._extend = self._add_scores if model.type == UNIGRAM else self._pair
        self._longest, self._matches = model.longest, model.automaton.iter
        self.start()

    def start(self) -> None:
        """Forgets the text so far."""
        self._text = ""  # the window: characters after the last committed boundary
        self._back = [0]  # per position, where the best last piece before it starts
        self._piece = [NOTHING]  # per position, that piece
        self._best = [0.0]  # per position, its path's score (unigram only)

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        for start in range(0, len(text), CHECK_EVERY):
            self._text += text[start : start + CHECK_EVERY]
            self._extend()
            if len(text) > CHECK_EVERY:
                out += self._commit()
        return out

    def finish(self) -> list[int]:
        return self._commit(final=True)

    def _outside(self, upto: int) -> None:
        """The positions up to `upto` that no piece leads to: one character each."""
        while len(self._back) <= upto:
            self._back.append(len(self._back) - 1)
            self._piece.append(OUTSIDE)

    def _pair(self) -> None:
        """Merges: the one piece that stands beside the last piece of the text before it."""
        back, last, known, width = self._back, self._piece, self._neighbours, PAIR
        done = len(back) - 1
        for at, (piece, length) in self._matches(self._text, max(0, done + 1 - self._longest)):
            if at < done:
                continue
            if at > done:
                self._outside(at)
                done = at
            start = at + 1 - length
            pair = last[start] * width + piece
            fits = known.get(pair)
            if fits is None:
                fits = self._side_by_side(last[start], piece)
            if fits:
                back.append(start)
                last.append(piece)
                done = at + 1
        if done < len(self._text):
            self._outside(len(self._text))

    def _add_scores(self) -> None:
        """Unigram: the highest sum of scores; of equals the path with the longest last piece."""
        scores, pieces, text = self.model.score, self.model.pieces, self._text
        ending: dict[int, list[tuple[int, int, float]]] = {}
        for at, (piece, length) in self._matches(text, max(0, len(self._back) - self._longest)):
            ending.setdefault(at + 1, []).append((piece, length, scores[pieces[piece]]))
        for end in range(len(self._back), len(text) + 1):
            options, best = ending.get(end, []), self._best
            if not any(length == 1 for _, length, _ in options):
                options = [*options, (OUTSIDE, 1, self.model.lowest - UNKNOWN_PENALTY)]
            piece, length, score = max(options, key=lambda x: (best[end - x[1]] + x[2], x[1]))
            self._back.append(end - length)
            self._piece.append(piece)
            best.append(best[end - length] + score)

    def _side_by_side(self, left: int, right: int) -> bool:
        a, b = self.model.pieces[left] if left >= 0 else "", self.model.pieces[right]
        fits = self._merged(a + b) == ([a, b] if a else [b])
        if len(self._neighbours) > MOST_NEIGHBOURS:
            self._neighbours.clear()
        self._neighbours[left * PAIR + right] = fits
        return fits

    def _merged(self, text: str) -> list[str]:
        """What merging makes of a short text: the best-scored neighbours first, the leftmost of equals."""
        score, none = self.model.score.get, float("-inf")
        parts = list(text)
        gains = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while gains and (best := max(gains)) > none:
            at = gains.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del gains[at]
            if at:
                gains[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(gains):
                gains[at] = score(parts[at] + parts[at + 1], none)
        return parts

    def _commit(self, final: bool = False) -> list[int]:
        """Ids up to the boundary in which all surviving paths meet; those of the whole window at the end."""
        back, end = self._back, len(self._text)
        boundary = end
        if not final:
            alive = set(range(max(0, end - self.model.longest + 1), end + 1))
            while len(alive) > 1:
                last = max(alive)
                alive.remove(last)
                alive.add(back[last])
            boundary = alive.pop()
        out: list[int] = []
        at = boundary
        while at:
            piece = self._piece[at]
            if piece >= 0:
                out.append(piece)
            else:
                out += self.model.ids_outside(self._text[at - 1])[::-1]
            at = back[at]
        out.reverse()
        if boundary and not final:
            self._text = self._text[boundary:]
            self._back = [0] + [max(0, b - boundary) for b in back[boundary + 1 :]]
            self._piece = self._piece[boundary:]
            self._best = [b - self._best[boundary] for b in self._best[boundary:]]
        return out

    @property
    def window(self) -> int:
        return len(self._text)


class Codec:
    """Whole texts to ids and back. Words that come again are remembered, up to a bound."""

    def __init__(self, data: bytes):
        self.model = PieceModel(data)
        self._viterbi = StreamingViterbi(self.model)
        codec = self

        class Words(dict):
            older: dict[str, tuple[int, ...]] = {}

            def __missing__(self, word: str) -> tuple[int, ...]:
                ids = self.older.get(word)
                if ids is None:
                    ids = tuple(codec._search(word))
                if len(word) <= LONGEST_CACHED:
                    if len(self) >= CACHED_WORDS:
                        self.older = dict(self)
                        self.clear()
                    self[word] = ids
                return ids

        self._words = Words()
        self._plain = [p.replace(SPACE, " ") if k in (NORMAL, USER) else "" for p, k in zip(self.model.pieces, self.model.kinds)]

    def _search(self, word: str) -> Iterable[int]:
        self._viterbi.start()
        return self._viterbi.feed(word) + self._viterbi.finish()

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        marked = (SPACE if self.model.prefix else "") + text.replace(" ", SPACE)
        return list(chain.from_iterable(map(self._words.__getitem__, self.model.words.findall(marked))))

    def decode(self, ids: Iterable[int]) -> str:
        out, held = [], bytearray()
        byte_of, plain = self.model.byte_of, self._plain
        for i in ids:
            byte = byte_of.get(i)
            if byte is not None:
                held.append(byte)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(" ⁇ " if i == self.model.unknown else plain[i])
        out.append(held.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if self.model.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker; `path` is a vocabulary file that every machine has."""
    with open(path, "rb") as file:
        return Codec(file.read())


# --- tables --------------------------------------------------------------------------------


def _in_slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def encoded(docs: DataFrame, path: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids array<int>, n_ids, and whether decoding the ids gives the text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in _in_slices(batches):
            lists, same = [], []
            for value in batch.column("text"):
                one = value.as_py() or ""
                ids = own.encode(one)
                lists.append(np.array(ids, np.int32))
                same.append(own.decode(ids) == one.replace(SPACE, " "))
            sizes = np.array([len(x) for x in lists], np.int32)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(sizes), pa.array(same)],
                ["doc_id", "ids", "n_ids", "lossless"],
            )

    some = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return some.mapInArrow(run, "doc_id bigint, ids array<int>, n_ids int, lossless boolean")


def decoded(rows: DataFrame, path: str = MODEL, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text of lists of ids; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in _in_slices(batches):
            texts = [own.decode(x.as_py() or []) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    some = rows.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))
    return some.mapInArrow(run, "doc_id bigint, text string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every whole document."""
    return encoded(table(spark, sf_dir, "documents"))
