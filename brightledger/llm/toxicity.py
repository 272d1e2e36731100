"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its lower-case words without ASCII punctuation and the first four, five and six bytes of each, so that endings do not
hide a stem. A text holds a term or not. Of the hashed terms, those whose presence is most clearly tied to a label in the sample get a weight and a vector, and so do those
of the most frequent ones that are tied to it together with another: two terms may tell nothing each and all together. The log odds are the sum of the weights plus the sum, over all pairs of terms present, of the product of
their vectors. So two terms that are harmless alone can count together, and the pairs cost no more than the terms: the sum over pairs is half of
the squared sum less the sum of squares. Weights and vectors are learned by stochastic gradient descent (Adagrad) in numpy.

Defined cases: null text counts as empty; a text without any of these terms gets the score of the bias; without labelled texts, or with one
label only, the score is the share of labels seen, 0.5 if there are none.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame

from . import subwords, training, words

BITS, PREFIXES = 20, (4, 5, 6)
SAMPLE, TERMS, LEAST_Z, SIZE, EPOCHS, RATE, DECAY = 4000, 4096, 2.5, 8, 12, 0.1, 1e-3
PAIRED, LEAST_COUNT, LEAST_PAIR_Z = 2048, 20, 6.0

_BLANKED = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def _terms(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, slot) of each term, repeats included."""
    split = words.split(data)
    owner, size = split.owner(), split.end - split.start
    owners, slots = [owner], [subwords.slots((split.hashes() >> np.uint64(32)).astype(np.uint32), BITS)]
    for n in PREFIXES:
        long = np.flatnonzero(size >= n)
        h = subwords.gram(split.data.astype(np.uint32), split.start[long], n)
        owners.append(owner[long])
        slots.append(subwords.slots(h, BITS))
    return np.concatenate(owners), np.concatenate(slots)


def _normal(text: str) -> bytes:
    return text.lower().encode().translate(_BLANKED)


def _distinct(owner: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(owner.astype(np.int64) << BITS | term)
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Model:
    """``place`` gives a slot's row in ``weight`` and ``vector``, or -1."""

    place: np.ndarray
    weight: np.ndarray
    vector: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        data = [_normal(t) for t in texts]
        out = np.zeros(len(data))
        for low, high in words.chunks(data):
            n = high - low
            owner, slot = _terms(data[low:high])
            row = self.place[slot]
            owner, row = _distinct(owner[row >= 0], row[row >= 0])
            odds = self.bias + np.bincount(owner, self.weight[row], n)
            for v in self.vector[row].T:
                odds += 0.5 * (np.bincount(owner, v, n) ** 2 - np.bincount(owner, v * v, n))
            out[low:high] = training.logistic(odds)
        return out


def _paired(owner: np.ndarray, slot: np.ndarray, y: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The terms, of the ``PAIRED`` most frequent ones, whose presence beside some other changes the odds beyond what each does alone.

    For each pair the log odds of the four cases (both, one, the other, neither) give the interaction and its standard error; ``LEAST_PAIR_Z`` allows for some million pairs.
    """
    n = len(y)
    frequent = np.argsort(-np.minimum(count, n - count), kind="stable")[:PAIRED]
    frequent = frequent[np.minimum(count, n - count)[frequent] >= LEAST_COUNT]
    column = np.full(1 << BITS, -1, np.int64)
    column[frequent] = np.arange(len(frequent))
    held = column[slot] >= 0
    present = np.zeros((n, len(frequent)), np.float32)
    present[owner[held], column[slot[held]]] = 1
    best = np.zeros(len(frequent))
    for low in range(0, len(frequent), 256):
        effect, variance = 0.0, 0.0
        for sign, rows in ((1, present[y == 1]), (-1, present[y == 0])):
            some, every = rows[:, low : low + 256], rows.sum(0)[None, :]
            both = some.T @ rows
            one, other = some.sum(0)[:, None] - both, every - both
            for odds, cell in ((1, both), (-1, one), (-1, other), (1, len(rows) - both - one - other)):
                effect = effect + sign * odds * np.log(cell + 0.5)
                variance = variance + 1 / (cell + 0.5)
        z = np.abs(effect) / np.sqrt(variance)
        best[low : low + 256] = z.max(1)
    return frequent[best >= LEAST_PAIR_Z]


def fit(rows: list[tuple[str, int]], seed: int = 0) -> Model:
    """Learn from (text, label) rows."""
    y = np.array([label for _, label in rows], np.int64)
    ones, zeros = int(y.sum()), int(len(y) - y.sum())
    bias = float(np.log((ones + 0.5) / (zeros + 0.5)))
    place = np.full(1 << BITS, -1, np.int32)
    if not ones or not zeros:
        return Model(place, np.zeros(0), np.zeros((0, SIZE)), bias)
    rng = np.random.default_rng(seed)
    parts = []
    for i, (text, _) in enumerate(rows):
        _, slot = _terms([_normal(text)])
        parts.append(np.int64(i) << BITS | np.unique(slot))
    key = np.concatenate(parts)
    owner, slot = key >> BITS, key & ((1 << BITS) - 1)
    toxic = y[owner] == 1
    a, b = (np.bincount(slot[t], minlength=1 << BITS) + 0.5 for t in (toxic, ~toxic))
    clear = np.abs(np.log(a / (ones + 1)) - np.log(b / (zeros + 1))) / np.sqrt(1 / a + 1 / b)
    clear[a + b < 5] = 0  # counts of at least four
    chosen = np.argsort(-clear, kind="stable")[:TERMS]
    chosen = chosen[clear[chosen] >= LEAST_Z]
    paired = _paired(owner, slot, y, (a + b - 1).astype(np.int64))
    chosen = np.concatenate([chosen, np.setdiff1d(paired, chosen)])
    place[chosen] = np.arange(len(chosen))
    row = place[slot]
    owner, row = owner[row >= 0], row[row >= 0]
    first = np.searchsorted(owner, np.arange(len(rows) + 1))
    weight, vector = np.zeros(len(chosen)), rng.normal(0, 0.05, (len(chosen), SIZE))
    weight_sum, vector_sum = np.full(len(chosen), 1e-2), np.full((len(chosen), SIZE), 1e-2)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            x = row[first[i] : first[i + 1]]
            own = vector[x]
            total = own.sum(0)
            odds = bias + weight[x].sum() + 0.5 * ((total**2).sum() - (own**2).sum())
            off = float(training.logistic(np.array(odds))) - y[i]
            bias -= 0.1 * RATE * off
            step = off + DECAY * weight[x]
            weight_sum[x] += step**2
            weight[x] -= RATE * step / np.sqrt(weight_sum[x])
            step = off * (total - own) + DECAY * own
            vector_sum[x] += step**2
            vector[x] -= 0.3 * RATE * step / np.sqrt(vector_sum[x])
    return Model(place, weight, vector, bias)


def learn(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "toxic", rows: int = SAMPLE) -> Model:
    """Learn from a bounded sample of the labelled documents for which ``keep`` holds."""
    return fit(training.sample(docs, labels, label, keep, rows))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (probability of label 1) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return training.scored(docs, lambda: shared.value.score)
