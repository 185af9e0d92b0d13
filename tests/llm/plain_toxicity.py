"""Kneser-Ney models of n-gram counts in one memory, to hold the tables' models against."""

import numpy as np

from vitrine.llm.toxicity import DISCOUNT, ORDER, ToxicityModel, _gram, _longer


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per key the sum of its weights, aligned with `keys`; and the number of keys like it that weigh something."""
    _, inverse = np.unique(keys, return_inverse=True)
    return np.bincount(inverse, weights)[inverse], np.bincount(inverse, weights > 0)[inverse]


def kneser_ney(points: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> ToxicityModel:
    """points: code points of each n-gram, one row of ORDER numbers; the counts are those of the classes.

    The plain form, in one memory, of what `_smoothed` computes on tables.
    """
    some = toxic + ordinary > 0
    points, toxic, ordinary = points[some].astype(np.uint64), toxic[some].astype(float), ordinary[some].astype(float)
    letter = points[:, -1]
    contexts = [np.zeros(len(points), np.uint64)]
    for back in range(1, ORDER):
        contexts.append(_longer(contexts[-1], points[:, ORDER - 1 - back], back))
    grams = [_gram(c, letter) for c in contexts]
    # The shared lower orders: in how many longer endings does an ending occur?
    shared = np.full(len(points), 1.0 / max(1, len(np.unique(letter))))
    for length in range(ORDER - 1):
        longer, first = np.unique(grams[length + 1], return_index=True)
        _, own, inverse = np.unique(grams[length][first], return_index=True, return_inverse=True)
        continuations = np.bincount(inverse).astype(float)
        total, kinds = _sums(contexts[length][first][own], continuations)
        gram_of = np.searchsorted(np.unique(grams[length]), grams[length])
        shared = np.maximum(continuations - DISCOUNT, 0)[gram_of] / total[gram_of] + (DISCOUNT * kinds / total)[gram_of] * shared
    context = contexts[-1]

    def of_class(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, kinds = _sums(context, counts)
        left = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        return np.maximum(counts - DISCOUNT, 0) / np.maximum(total, 1) + left * shared, left

    (p_toxic, left_toxic), (p_ordinary, left_ordinary) = of_class(toxic), of_class(ordinary)
    keys, first = np.unique(context, return_index=True)
    return ToxicityModel(
        grams[-1], (np.log(p_toxic) - np.log(p_ordinary)).astype(np.float32),
        keys, (np.log(left_toxic) - np.log(left_ordinary))[first].astype(np.float32),
    )
