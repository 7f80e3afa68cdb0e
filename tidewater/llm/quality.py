"""Quality of documents by a linear-chain conditional random field over their lines.

Each line is good or bad.  Its features are cuts of simple shares (capitals, symbols,
repeated words, lone signs, ...), those of the line itself and of its two neighbours; the
chain adds how the labels of neighbours go together.  Forward-backward gives the marginal of
each line, and the mean of the marginals, weighted by line length, is the document's score.

Only documents are labelled.  Lines begin with the label of their document; after a first
fit the lines of bad documents that look good are labelled anew and the field is fitted
again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

#: Documents of each label that are learned from, their characters and their lines, at most.
PER_LABEL, MAX_CHARS, MAX_LINES = 1000, 20_000, 60
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_SPACE = b" \t\r\x0b\x0c"
# Where each share is cut; a feature for each cut says that it is exceeded
CUTS = {
    "upper": (0.3, 0.6),
    "symbols": (0.06, 0.12, 0.2),
    "digits": (0.1, 0.3),
    "repeated": (0.3, 0.6, 0.85),
    "stutter": (0.2, 0.5),
    "lone": (0.15, 0.35),
    "marked": (0.3, 0.6),
}
OWN = sum(map(len, CUTS.values()))
#: own features, those of both neighbours, no neighbour before or after, bias
WIDTH = 3 * OWN + 3
_ENDS = _LETTERS + _DIGITS + b".,;:?"


def _line(line: bytes) -> tuple | None:
    words = line.split()
    if not (n := len(words)):
        return None
    size = sum(map(len, words))
    letters = size - len(line.translate(None, _LETTERS + _SPACE))
    upper = len(line) - len(line.translate(None, _UPPER))
    digits = len(line) - len(line.translate(None, _DIGITS))
    marked = sum(w[-1] not in _ENDS for w in words)
    return (
        upper / max(1, letters),
        (size - letters - digits) / size,
        digits / size,
        1 - len(set(words)) / n if n > 3 else 0.0,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(len(w) == 1 and w not in _LONE for w in words) / n,
        marked / n,
        len(line),
    )


_LONE = {bytes([c]) for c in _LETTERS + _DIGITS}


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and lengths of the lines that hold words."""
    found = [f for f in map(_line, text.encode("utf-8", "surrogatepass").split(b"\n")) if f]
    if not found:
        return np.zeros((0, WIDTH), np.float32), np.zeros(0)
    raw = np.array(found)
    own = np.concatenate([raw[:, [i]] > np.array(cuts) for i, cuts in enumerate(CUTS.values())], axis=1).astype(np.float32)
    blank = np.zeros((1, OWN), np.float32)
    edge = np.zeros((len(own), 3), np.float32)
    edge[0, 0] = edge[-1, 1] = 1
    edge[:, 2] = 1
    return np.concatenate([own, np.vstack([blank, own[:-1]]), np.vstack([own[1:], blank]), edge], axis=1), raw[:, -1]


class Field:
    """weights: of the good label for each feature; links: of the labels of two neighbours;
    scale, shift: from the log odds of a document's mean to those of its label."""

    def __init__(self, weights: np.ndarray | None = None, links: np.ndarray | None = None):
        self.weights = np.zeros(WIDTH) if weights is None else weights
        self.links = np.zeros((2, 2)) if links is None else links
        self.scale, self.shift = 1.0, 0.0

    def marginals(self, emit: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """emit: score of good, documents by lines, padded; marginals of good, of label pairs,
        and the log partition of each document."""
        docs, length = emit.shape
        push = np.zeros((docs, length, 2))
        push[:, :, 1] = emit
        forward = np.zeros((docs, length, 2))
        back = np.zeros((docs, length, 2))
        forward[:, 0] = push[:, 0]
        for t in range(1, length):
            step = np.logaddexp(forward[:, t - 1, 0, None] + self.links[0], forward[:, t - 1, 1, None] + self.links[1]) + push[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        for t in range(length - 2, -1, -1):
            ahead = back[:, t + 1] + push[:, t + 1]
            step = np.logaddexp(ahead[:, 0, None] + self.links[:, 0], ahead[:, 1, None] + self.links[:, 1])
            back[:, t] = np.where(mask[:, t + 1, None], step, 0)
        whole = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        good = np.exp(np.minimum(0, forward[:, :, 1] + back[:, :, 1] - whole[:, None])) * mask
        pairs = np.zeros((2, 2))
        if length > 1:
            both = mask[:, 1:, None, None]
            joint = forward[:, :-1, :, None] + self.links + (push + back)[:, 1:, None, :] - whole[:, None, None, None]
            pairs = (np.exp(np.minimum(0, joint)) * both).sum(axis=(0, 1))
        return good, pairs, whole

    def fit(self, x: np.ndarray, mask: np.ndarray, labels: np.ndarray, rounds: int = 120) -> Field:
        """Gradient steps (Adam) on the mean log likelihood of the labels, with a penalty."""
        n = mask.sum()
        truth = np.zeros((2, 2))
        if x.shape[1] > 1:
            a, b, both = labels[:, :-1], labels[:, 1:], mask[:, 1:]
            for i in (0, 1):
                for j in (0, 1):
                    truth[i, j] = ((a == i) & (b == j) & both).sum()
        theta = np.concatenate([self.weights, self.links.ravel()])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        flat = x.reshape(-1, WIDTH)
        for i in range(1, rounds + 1):
            self.weights, self.links = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
            good, pairs, _ = self.marginals((flat @ self.weights).reshape(mask.shape), mask)
            miss = ((labels - good) * mask).reshape(-1)
            slope = np.concatenate([flat.T @ miss, (truth - pairs).ravel()]) / n - 1e-3 * theta
            m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
            theta = theta + 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
        self.weights, self.links = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        return self

    def calibrated(self, mean: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * _odds(mean) + self.shift, -50, 50))))

    def calibrate(self, means: np.ndarray, labels: np.ndarray, rounds: int = 50) -> None:
        """Newton steps on the log likelihood of the documents' labels, both labels alike in
        weight, with a penalty that holds where they can be told apart."""
        if labels.min() == labels.max():
            return
        x = np.stack([_odds(means), np.ones(len(means))], axis=1)
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
        w = np.array([1.0, 0.0])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
            slope = x.T @ (weight * (labels - p)) - 0.1 * (w - [1.0, 0.0])
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
            step = np.linalg.solve(curve, slope)
            w = w + step * min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        if w[0] > 0:  # a better mean never lowers the score
            self.scale, self.shift = float(w[0]), float(w[1])

    def scores(self, texts: list[str | None], cells: int = 200_000) -> list[float]:
        """Score of each text; texts of like length run through the chain side by side."""
        found = [lines(t or "") for t in texts]
        out = [0.0] * len(texts)
        order = sorted((i for i, f in enumerate(found) if len(f[1])), key=lambda i: len(found[i][1]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(found[order[end]][1]) * (end + 1 - at) <= cells and len(found[order[end]][1]) <= 2 * len(found[order[at]][1]) + 8:
                end += 1
            group = order[at:end]
            length = len(found[group[-1]][1])
            emit, mask = np.zeros((len(group), length)), np.zeros((len(group), length), bool)
            for row, i in enumerate(group):
                emit[row, : len(found[i][1])] = found[i][0] @ self.weights
                mask[row, : len(found[i][1])] = True
            good, _, _ = self.marginals(emit, mask)
            for row, i in enumerate(group):
                size = found[i][1]
                out[i] = self.calibrated(float(good[row, : len(size)] @ size / size.sum()))
            at = end
        return out


def _odds(mean):
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def trained(texts: list[str], labels: list[int], max_lines: int = MAX_LINES) -> Field:
    """A field fitted to documents and their labels, 1 for good; untrained without any."""
    found = [(lines(t), q) for t, q in zip(texts, labels)]
    # the chains are held side by side, so documents of very many lines are not learned from
    found = [(f, q) for f, q in found if 0 < len(f[1]) <= max_lines]
    field = Field()
    if not found:
        return field
    length = max(len(size) for (_, size), _ in found)
    x = np.zeros((len(found), length, WIDTH), np.float32)
    mask = np.zeros((len(found), length), bool)
    y = np.zeros((len(found), length))
    bad = np.array([q == 0 for _, q in found])
    for i, ((rows, _), q) in enumerate(found):
        x[i, : len(rows)], mask[i, : len(rows)], y[i, : len(rows)] = rows, True, q
    field.fit(x, mask, y)
    good, _, _ = field.marginals(x @ field.weights, mask)
    y[bad] = (good[bad] > 0.6) & mask[bad]
    field.fit(x, mask, y)
    good, _, _ = field.marginals(x @ field.weights, mask)
    length = np.zeros(mask.shape)
    for i, ((_, size), _) in enumerate(found):
        length[i, : len(size)] = size
    field.calibrate((good * length).sum(axis=1) / length.sum(axis=1), (~bad).astype(float))
    return field


def fit(docs: DataFrame, labels: DataFrame, *, per_label: int = PER_LABEL, max_chars: int = MAX_CHARS, max_lines: int = MAX_LINES) -> Field:
    """A field of the documents that ``labels`` (doc_id, quality) marks.

    Learned from a bounded sample: of each label the ``per_label`` ids with the least hash,
    texts of at most ``max_chars`` characters and ``max_lines`` lines, of a repeated id the
    least one.  Labels that are null or neither 0 nor 1, and ids that the documents lack,
    are left out.
    """
    marked = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("doc_id is not null and quality in (0, 1)").distinct()
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    # twice per_label rows at most: bounded, whatever the table's size
    chosen = marked.where("quality = 0").orderBy(*order).limit(per_label).unionAll(marked.where("quality = 1").orderBy(*order).limit(per_label))
    sample = (
        docs.select(F.col("doc_id").cast("long"), "text").where(F.length("text") <= max_chars)
        .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
        .toPandas().sort_values(["doc_id", "quality"], ignore_index=True)
    )
    return trained(sample["text"].tolist(), sample["quality"].tolist(), max_lines)


def score(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, score`` for every row of ``docs`` (doc_id, text).

    A null text, or one without words, has no good line and scores 0.  Rows are independent;
    repeated ones give equal results.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": field.scores(batch["text"].tolist())})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)


def keep_good(docs: DataFrame, field: Field, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``; columns untouched."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(field.scores(texts.tolist()), dtype=float)

    return docs.where(scored("text") >= threshold)
