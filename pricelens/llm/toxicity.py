"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score is logistic in its hashed
words; the document's score is the noisy-or of its sentences, so one offending
sentence is enough and a long clean text stays clean.  Only document labels are
known: the gradient of the noisy-or tells which sentence has to carry a label.
The same sentence scores then locate the offending sentences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, fitted, held_out, labelled_sample, without
from .hashing import ALNUM, join, prefix, spans, words

BITS = 18
#: At most so many labelled documents are used for fitting.
SAMPLE = 8000
ENDS = np.zeros(256, dtype=bool)
ENDS[[10, 33, 46, 63]] = True


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # by word slot
    bias: float


def sentences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word slots and each word's sentence; each sentence's text, first and last byte in it.

    Words are runs of letters and digits (any byte from 128 counts as one), A-Z
    lower-cased.  A sentence ends at ``.``, ``!``, ``?`` or a line end; one
    without words is none.
    """
    data, at = join(texts)
    start, end = words(data, ALNUM)
    slot = (spans(prefix(data, seed=2, lower=True), start, end) >> np.uint64(64 - BITS)).astype(np.int64)
    doc = np.searchsorted(at, start, side="right") - 1
    stop = np.concatenate([[0], np.cumsum(ENDS[data])])[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (stop[1:] != stop[:-1])
    sentence = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1 if len(start) else first
    of = doc[first]
    return slot, sentence, of, start[first] - at[of], end[last] - at[of]


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def telling(slots: np.ndarray, doc: np.ndarray, y: np.ndarray, errors: float, least: int) -> np.ndarray:
    """Slots whose share of documents differs between the labels by ``errors`` standard errors,
    in at least ``least`` documents."""
    pair = np.unique(doc * (1 << BITS) + slots)
    slot, label = pair % (1 << BITS), y[pair >> BITS]
    n1, n0 = y.sum(), len(y) - y.sum()
    p = np.bincount(slot[label == 1], minlength=1 << BITS)
    q = np.bincount(slot[label == 0], minlength=1 << BITS)
    share = (p + q) / len(y)
    gap = np.abs(p / n1 - q / n0) / np.sqrt(np.maximum(share * (1 - share) * (1 / n1 + 1 / n0), 1e-12))
    return (p + q >= least) & (gap >= errors)


def fit(slots: np.ndarray, sentence: np.ndarray, of: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 0.1,
        shrink: float = 0.05, errors: float = 4.0, least: int = 3) -> Model:
    """Full-batch Adam on the noisy-or likelihood.

    Only words that tell the labels apart (``errors``, ``least``) get a weight;
    ``shrink`` is the precision of a normal prior on it.
    """
    weights = np.zeros(1 << BITS)
    use = telling(slots, of[sentence], y, errors, least)[slots] if len(slots) else np.zeros(0, bool)
    names, idx = np.unique(slots[use], return_inverse=True)
    sent, n = sentence[use], len(of)
    w = np.append(np.zeros(len(names)), -4.0)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        z = np.bincount(sent, weights=w[idx], minlength=n) + w[-1]
        total = np.bincount(of, weights=softplus(z), minlength=len(y))
        # d loss / d total: 1 for a clean text, -1 / (e^total - 1) for an offending one
        pull = np.where(y == 1, -1.0 / np.expm1(np.clip(total, 1e-6, 50.0)), 1.0)
        g_z = pull[of] / (1.0 + np.exp(-np.clip(z, -50, 50)))
        g = np.append(np.bincount(idx, weights=g_z[sent], minlength=len(names)), g_z.sum()) / len(y)
        g[:-1] += shrink / len(y) * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights[names] = w[:-1]
    return Model(weights.astype(np.float32), float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE) -> Model:
    """Fit on at most ``bound`` labelled documents outside the held-out fold.

    Without labelled documents, or with one label only, every word weighs zero.
    """

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in blocks(batches, "text"):
            slot, sentence, of, _, _ = sentences(texts)
            bounds = np.searchsorted(of[sentence], np.arange(len(texts) + 1))
            packed = [np.stack([slot[a:b], sentence[a:b]]).astype(np.int32).tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([piece.column("y"), pa.array(packed, pa.binary())], ["y", "bag"])

    def one(table: pa.Table) -> pa.Table:
        y = table.column("y").to_numpy()
        slots, sents, of, seen = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for i, raw in enumerate(table.column("bag").to_pylist()):
            slot, sent = np.frombuffer(raw, dtype=np.int32).reshape(2, -1).astype(np.int64)
            if len(slot):
                names, own = np.unique(sent, return_inverse=True)
                slots.append(slot)
                sents.append(own + seen)
                of.append(np.full(len(names), i))
                seen += len(names)
        model = fit(np.concatenate(slots), np.concatenate(sents), np.concatenate(of), y) if 0 < y.sum() < len(y) else Model(np.zeros(1 << BITS, np.float32), -4.0)
        return pa.table({"weights": pa.array([model.weights.tobytes()], pa.binary()), "bias": [model.bias]})

    got = fitted(labelled_sample(docs, labels, label, bound).mapInArrow(bags, "y int, bag binary"), one, "weights binary, bias double")
    if not got:
        return Model(np.zeros(1 << BITS, np.float32), -4.0)
    return Model(np.frombuffer(bytes(got[0].weights), dtype=np.float32), got[0].bias)


def score(docs: DataFrame, model: Model, ids: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Score of every document and its offending sentences.

    Returns ``ids``, score (0 to 1), predicted (score >= 0.5) and ``spans``:
    first byte, end byte and score of each sentence with score >= 0.5.  A null
    or empty text, or one without words, scores 0.  Other columns are ignored;
    repeated rows are scored alike; an empty table gives no rows.  The model is
    2^18 numbers whatever the input, so it is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    slim = docs.select(*ids, F.col(text).cast("binary").alias("__text"))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    schema = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in ids)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for piece, texts in blocks(batches, "__text"):
            slot, sentence, of, first, last = sentences(texts)
            z = np.bincount(sentence, weights=weights[slot], minlength=len(of)) + bias
            total = np.bincount(of, weights=softplus(z), minlength=len(texts))
            doc_score = -np.expm1(-total)
            own = 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))
            found: list[list] = [[] for _ in texts]
            for s in np.flatnonzero(own >= 0.5):
                found[of[s]].append({"start": int(first[s]), "end": int(last[s]), "score": float(own[s])})
            cols, names = without(piece, "__text")
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(doc_score), pa.array((doc_score >= 0.5).astype(np.int32)), pa.array(found, pa.list_(span))],
                [*names, "score", "predicted", "spans"])

    return slim.mapInArrow(scored, f"{schema}, score double, predicted int, spans array<struct<start: long, end: long, score: double>>")


def toxicity(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending spans of every document."""
    out = score(docs, train(docs, labels, bound=bound))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "spans")
