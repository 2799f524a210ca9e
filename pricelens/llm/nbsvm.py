"""Quality classifier: naive Bayes features in a support vector machine.

A document is a set of n-gram indicators: words and word pairs, and runs of one
to three word shapes (case, punctuation, digits, length, same as the word
before), which carry over to unseen vocabularies.  Each indicator is scaled by
the log-count ratio of the two classes; a linear hinge-loss model on top is
fitted by dual coordinate descent, and a logistic curve on a held-back fifth of
the sample turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SMALL, blocks, fitted, held_out, labelled_sample, without
from .hashing import U, combine, join, prefix, spans, words

BITS = 18
SLOTS = 1 << BITS
#: At most so many labelled documents are used for fitting.
SAMPLE = 8000
UPPER, LOWER, DIGIT, MARK, OTHER = (np.zeros(256, dtype=np.int64) for _ in range(5))
UPPER[65:91] = LOWER[97:123] = DIGIT[48:58] = OTHER[128:] = 1
MARK[33:48] = MARK[58:65] = MARK[91:97] = MARK[123:127] = 1
for _c in b".,;:'\"-()":
    MARK[_c] = 0


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # by slot, log-count ratio times weight
    bias: float
    slope: float
    shift: float


def indicators(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram slots of every text: (slots in text order, bounds per text)."""
    data, at = join(texts)
    start, end = words(data)
    doc = np.searchsorted(at, start, side="right") - 1
    word = spans(prefix(data, seed=3, lower=True), start, end)

    def count(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[data])])
        return sums[end] - sums[start]

    up, low, digit, mark, other = (count(k) for k in (UPPER, LOWER, DIGIT, MARK, OTHER))
    same = np.zeros(len(word), dtype=bool)
    same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    length = np.digitize(end - start, [2, 5, 12, 30])
    shape = (((up > 1) & (low == 0)) * 1 + (UPPER[data[start]] == 1) * 2 + (digit > 0) * 4 + (mark > 0) * 8
             + (mark > 2) * 16 + (up + low + digit + other == 0) * 32 + same * 64 + length * 128).astype(U)
    grams = [(word, 1, 0), (word, 2, 1), (shape + U(1), 1, 2), (shape + U(1), 2, 3), (shape + U(1), 3, 4)]
    keys = []
    for values, n, kind in grams:
        slot = (combine(values ^ U(kind << 56), n) >> U(64 - BITS)).astype(np.int64)
        whole = doc[n - 1:] == doc[: len(doc) - n + 1] if len(doc) >= n else np.zeros(0, bool)
        keys.append(doc[: len(slot)][whole] * SLOTS + slot[whole])
    key = np.unique(np.concatenate(keys))
    return key % SLOTS, np.searchsorted(key, np.arange(len(texts) + 1) * SLOTS)


def log_count_ratio(slots: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log of the smoothed share of each indicator among positives over that among negatives; a text's slots are distinct."""
    p, q = np.full(SLOTS, smooth), np.full(SLOTS, smooth)
    for own, label in zip(slots, y):
        if label in (0, 1):
            (p if label else q)[own] += 1
    return np.log((p / p.sum()) / (q / q.sum()))


def descend(slots: list[np.ndarray], y: np.ndarray, r: np.ndarray, cost: float = 1.0, epochs: int = 12) -> tuple[np.ndarray, float]:
    """Hinge loss by dual coordinate descent: one dual variable per document, box [0, cost]."""
    w, bias = np.zeros(SLOTS), 0.0
    alpha, sign = np.zeros(len(y)), np.where(y == 1, 1.0, -1.0)
    square = r * r
    norm = np.array([square[s].sum() + 1.0 for s in slots])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(y)):
            s = slots[i]
            gap = sign[i] * (w[s] @ r[s] + bias) - 1.0
            new = min(max(alpha[i] - gap / norm[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                w[s] += step * r[s]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3 * cost / max(1.0, float(np.median(norm))):
            break
    return w, bias


def logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, targets smoothed by class size."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ b, -30, 30)))
        hess = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-6 * np.eye(2)
        b = b - np.clip(np.linalg.solve(hess, x.T @ (p - target)), -2.0, 2.0)
    return float(max(b[0], 1e-3)), float(b[1])


def fit(slots: list[np.ndarray], y: np.ndarray) -> Model:
    """Every fifth document calibrates, the others fit; with one class only all margins are zero."""
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(SLOTS, np.float32), 0.0, 1.0, 0.0 if not len(y) else (4.0 if y[0] else -4.0))
    back = np.arange(len(y)) % 5 == 0
    if not (0 < y[back].sum() < back.sum() and 0 < y[~back].sum() < (~back).sum()):
        back[:] = False
    own = [s for s, b in zip(slots, back) if not b]
    r = log_count_ratio(own, y[~back])
    w, bias = descend(own, y[~back], r)
    both = w * r
    check = [s for s, b in zip(slots, back) if b] if back.any() else own
    margin = np.array([both[s].sum() + bias for s in check])
    slope, shift = logistic(margin, y[back] if back.any() else y)
    return Model(both.astype(np.float32), bias, slope, shift)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE) -> Model:
    """Fit on at most ``bound`` labelled documents outside the held-out fold."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in blocks(batches, "text", SMALL):
            slot, at = indicators(texts)
            packed = [slot[a:b].astype(np.int32).tobytes() for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("y"), pa.array(packed, pa.binary())], ["doc_id", "y", "slots"])

    def one(table: pa.Table) -> pa.Table:
        # views in order of id: the sample's slots stay where they came in
        order, packed = np.argsort(table.column("doc_id").to_numpy(), kind="stable"), table.column("slots")
        slots = [np.frombuffer(packed[int(i)].as_buffer(), dtype=np.int32) for i in order]
        m = fit(slots, table.column("y").to_numpy()[order])
        return pa.table({"weights": pa.array([m.weights.tobytes()], pa.binary()), "bias": [m.bias], "slope": [m.slope], "shift": [m.shift]})

    got = fitted(labelled_sample(docs, labels, label, bound).mapInArrow(sets, "doc_id long, y int, slots binary"), one,
                 "weights binary, bias double, slope double, shift double")
    if not got:
        return Model(np.zeros(SLOTS, np.float32), 0.0, 1.0, 0.0)
    return Model(np.frombuffer(bytes(got[0].weights), dtype=np.float32), got[0].bias, got[0].slope, got[0].shift)


def score(docs: DataFrame, model: Model, ids: tuple[str, ...] = ("doc_id",), text: str = "text", keep: tuple[str, ...] = (),
          least: float = 0.3, named: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Score of every document: ``ids``, the columns of ``keep``, score (0 to 1), predicted (score >= ``least``).

    A null or empty text has no indicators and gets the score of the bias
    alone.  Columns not named are ignored; repeated rows are scored alike; an
    empty table gives no rows.  The model has 2^18 numbers whatever the input.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cols = list(dict.fromkeys([*ids, *keep]))
    slim = docs.select(*cols, F.col(text).cast("binary").alias("__text"))
    schema = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in cols)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for piece, texts in blocks(batches, "__text", SMALL):
            slot, at = indicators(texts)
            # each text summed by itself, so that its score is the same in any block
            margin = np.array([m.weights[slot[a:b]].sum(dtype=np.float64) for a, b in zip(at, at[1:])]) + m.bias
            p = 1.0 / (1.0 + np.exp(-np.clip(m.slope * margin + m.shift, -30, 30)))
            arrays, names = without(piece, "__text")
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(p), pa.array((p >= least).astype(np.int32))], [*names, *named])

    return slim.mapInArrow(scored, ", ".join(x for x in (schema, f"{named[0]} double, {named[1]} int") if x))


def quality(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    out = score(docs, train(docs, labels, bound=bound))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """The documents whose score reaches 0.3, all columns unchanged.

    A null or empty text has the score of the bias alone; repeated rows are kept
    or go together; an empty table gives no rows; without labelled documents all stay.
    """
    model = train(docs, labels, bound=bound)
    out = score(docs, model, ids=(), keep=tuple(docs.columns), named=("__score", "__predicted"))
    return out.where("__predicted = 1").select(*docs.columns)
