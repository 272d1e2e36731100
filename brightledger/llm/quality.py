"""A supervised quality classifier over subword embeddings.

Every word, character n-gram (3 to 5 bytes with the blanks around a word) and word shape of a text is hashed to a row of a table of vectors.
A text is the mean over these kinds of the mean of their vectors, and a softmax layer gives the probability of each label. Vectors and layer
are learned together by stochastic gradient descent in numpy, on a bounded sample of labelled texts.

For scoring, a row's vector matters only through the layer, so the model that goes to the tasks is one number for each row:
about 1 MB, whatever the size of the corpus.

Defined cases: null text counts as empty; a text without words gets the score of the bias alone; without any labelled text, or
with one label only, the model knows nothing else than the share of labels seen, and scores 0.5 if there are none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame

from . import subwords, training, words

BITS, GRAMS, KINDS = 18, (3, 4, 5), 5
SAMPLE, SIZE, STEPS, RATE = 3000, 8, 15_000, 1.0


def _parts(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    found, split = subwords.features(texts, BITS, GRAMS)
    return [*found, (split.owner(), subwords.shapes(split, BITS))]


@dataclass
class Model:
    """What each hashed feature adds to the log odds of label 1, and the bias."""

    weight: np.ndarray
    bias: float

    @property
    def informed(self) -> bool:
        """Whether texts differ in score; not so without labels of both kinds."""
        return bool(self.weight.any())

    def score(self, texts: list[str]) -> np.ndarray:
        data = [t.encode() for t in texts]
        out = np.zeros(len(data))
        for low, high in words.chunks(data):
            n, total = high - low, np.zeros(high - low)
            for owner, slot in _parts(data[low:high]):
                count = np.maximum(np.bincount(owner, minlength=n), 1)
                total += np.bincount(owner, self.weight[slot], n) / count
            out[low:high] = training.logistic(total / KINDS + self.bias)
        return out


def fit(rows: list[tuple[str, int]], seed: int = 0) -> Model:
    """Learn from (text, label) rows."""
    if len({y for _, y in rows}) < 2:
        share = (sum(y for _, y in rows) + 0.5) / (len(rows) + 1)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    known = []
    for text, label in rows:
        parts = [slot for _, slot in _parts([text.encode()])]
        share = np.concatenate([np.full(len(p), 1 / (max(1, len(p)) * KINDS)) for p in parts])
        slots, at = np.unique(np.concatenate(parts), return_inverse=True)
        known.append((slots, np.bincount(at, share, len(slots)).astype(np.float32), label))
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (1 << BITS, SIZE)).astype(np.float32)
    layer, bias = np.zeros((SIZE, 2), np.float32), np.zeros(2, np.float32)
    # Few texts are gone through more often: the number of steps is fixed.
    passes = -(-STEPS // len(known))
    order = np.concatenate([rng.permutation(len(known)) for _ in range(passes)])
    for step, i in enumerate(order.tolist()):
        slots, share, label = known[i]
        rate = RATE * (1 - step / len(order))
        text = share @ vectors[slots]
        odds = text @ layer + bias
        off = np.exp(odds - odds.max())
        off /= off.sum()
        off[label] -= 1
        back = layer @ off
        layer -= rate * np.outer(text, off)
        bias -= 0.1 * rate * off
        vectors[slots] -= (rate * share)[:, None] * back
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "quality", rows: int = SAMPLE) -> Model:
    """Learn from a bounded sample of the labelled documents for which ``keep`` holds."""
    return fit(training.sample(docs, labels, label, keep, rows))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (probability of label 1) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return training.scored(docs, lambda: shared.value.score)


def accepted(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """The rows with a score of at least ``least``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return training.filtered(docs, lambda: shared.value.score, least)
