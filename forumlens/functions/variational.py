"""Steps of topic models over arrays: plain numpy that runs inside tasks."""

from __future__ import annotations

import numpy as np

STEP_ENTRIES = 200_000
BLOCK_ENTRIES = 20_000  # of documents whose steps are taken together; longer ones are alone
CHANGE = 1e-3  # of a document's topics, in the mean, at which its steps end


def digamma_of(x: np.ndarray) -> np.ndarray:
    """By its series at ``x + 6``, and the recurrence down from there; for positive numbers."""
    x = np.asarray(x, float)
    y = x + 6
    square = y * y
    series = np.log(y) - 0.5 / y - (1 / 12 - (1 / 120 - 1 / (252 * square)) / square) / square
    pair = x * (x + 5)  # the six terms 1 / (x + i), two by two
    return series - (2 * x + 5) * (1 / pair + 1 / (pair + 4) + 1 / (pair + 6))


def trigamma_of(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    y = x + 6
    series = 1 / y + 0.5 / y**2 + (1 / 6 - (1 / 30 - 1 / (42 * y**2)) / y**2) / y**3
    for i in range(6):
        series = series + 1 / (x + i) ** 2
    return series


def dealt_sums(
    state: np.ndarray, where: np.ndarray, n: np.ndarray, share: np.ndarray, counts: np.ndarray, sums: np.ndarray
) -> np.ndarray:
    """Entries in runs, of ``counts`` each, dealt to the topics: the sum of each run, which has at
    least one entry; what goes to the entries' places is added to ``sums``."""
    new = np.zeros_like(share)
    ends = np.cumsum(counts)
    first = 0
    while first < len(counts):
        begun = ends[first] - counts[first]
        last = max(first + 1, int(np.searchsorted(ends, begun + STEP_ENTRIES, "right")))
        some, at = slice(begun, ends[last - 1]), where[begun : ends[last - 1]]
        dealt = state[at] * np.repeat(share[first:last], counts[first:last], axis=0)
        dealt *= (n[some] / np.maximum(dealt.sum(1), 1e-300))[:, None]
        new[first:last] = np.add.reduceat(dealt, ends[first:last] - counts[first:last] - begun)
        used, back = np.unique(at, return_inverse=True)
        for i in range(sums.shape[1]):
            sums[used, i] += np.bincount(back, dealt[:, i], len(used))
        first = last
    return new


def document_topics(
    n: np.ndarray, share: np.ndarray, counts: np.ndarray, prior: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Variational weights of the topics of documents, each a run of entries, and every entry's
    count dealt to the topics. A document's steps end by themselves, whatever is beside it.

    Documents of like length are one block, filled up with entries that count 0.
    """
    size, k = len(counts), len(prior)
    found, dealt = np.ones((size, k)), np.empty((len(n), k))
    starts = np.cumsum(counts) - counts
    order = np.argsort(counts, kind="stable")
    lengths, first = counts[order], 0
    while first < size:
        longest = lengths[first] * 5 // 4 + 8
        last = min(int(np.searchsorted(lengths, longest, "right")), first + max(1, BLOCK_ENTRIES // int(longest)))
        some, width = order[first:last], np.arange(lengths[last - 1])
        inside = width < counts[some, None]
        at = starts[some, None] + np.where(inside, width, 0)
        values, times = share[at].astype(float), np.where(inside, n[at], 0.0)
        found[some] = own = _settled(values, times, prior)
        theta = np.exp(digamma_of(own) - digamma_of(own.sum(1, keepdims=True)))
        values *= theta[:, None]
        values *= (times / (values.sum(2) + 1e-100))[:, :, None]
        dealt[at[inside]] = values[inside]
        first = last
    return found, dealt


def _settled(values: np.ndarray, times: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Topics of a block of documents: ``values`` by document, entry and topic."""
    size, k = len(values), len(prior)
    found, live, going = np.ones((size, k)), np.arange(size), np.ones(size, bool)
    while number := np.count_nonzero(going):
        if number < 0.75 * len(going):  # the others are done
            live, values, times = live[going], values[going], times[going]
            going = going[going]
        own = found[live]
        theta = np.exp(digamma_of(own))  # what it is divided by falls out of the next line but one
        norm = np.matmul(values, theta[:, :, None])[:, :, 0] + 1e-100
        new = theta * np.matmul((times / norm)[:, None], values)[:, 0] + prior
        found[live[going]] = new[going]
        going = going & (np.abs(new - own).sum(1) / k > CHANGE)
    return found
