"""Texts as arrays of code points, letters apart from everything else."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE = 32
SLICE = 400_000  # characters of a text that are worked on at once; longer texts are cut after a sign that is no letter


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    known = np.zeros(0x110000, bool)
    for first, last in ((0, 0xD800), (0xE000, 0x32000), (0xE0000, 0xE1000)):
        known[first:last] = np.fromiter(map(str.isalpha, map(chr, range(first, last))), bool, last - first)
    return known


def _between_words(text: str) -> int:
    """Where a text longer than SLICE is cut: after its last sign within SLICE that is no letter, else after the
    first one beyond, so that no word is ever cut."""
    before = next((i + 1 for i in range(SLICE - 1, -1, -1) if not text[i].isalpha()), None)
    return before or next((i + 1 for i in range(SLICE, len(text)) if not text[i].isalpha()), len(text))


def slices(texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Groups of lower-cased texts of about SLICE characters, with the position of each one's text in `texts`.

    A longer group holds a single word of that length.
    """
    group, at, size = [], [], 0
    for number, text in enumerate(texts):
        rest = (text or "").lower()
        while rest:
            part, rest = rest, ""
            if len(part) > SLICE:
                cut = _between_words(part)
                part, rest = part[:cut], part[cut:]
            group.append(part)
            at.append(number)
            size += len(part)
            if size >= SLICE:
                yield group, np.array(at)
                group, at, size = [], [], 0
    if group:
        yield group, np.array(at)


def letters(group: list[str], at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, text number, is a letter) of the letters and of one space after each run of them."""
    points = np.frombuffer(" ".join([*group, ""]).encode("utf-32-le", "replace"), np.uint32)
    number = np.repeat(at, [len(x) + 1 for x in group])
    letter = _is_letter()[points]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    return np.where(letter, points, SPACE)[kept].astype(np.uint64), number[kept], letter[kept]


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
