"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. A passage is described by the pairs of neighbouring
character classes and by its words' lengths and repetitions, and encoded by a layer that is learnt with
the rest. Gated attention gives each encoded passage a weight, and the weighted sum is scored. All of it
is learnt from document labels alone, on a sample of at most SAMPLE labelled documents with at most
SAMPLE_PASSAGES passages each, the bound of what the driver holds; every document is scored whole.

Defined cases: a null or empty text is one passage without characters, so it has a score; labels that
disagree on a document count as the lowest; without labels of both kinds the score is the share of
label 1, or 0.5 without any; a null doc_id has no label; repeated rows get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.llm import textarrays as ta

PASSAGE = 64
SAMPLE, SAMPLE_PASSAGES = 4000, 200
HIDDEN, GATE = 24, 12
EPOCHS, BAGS, RATE, DECAY = 25, 64, 0.01, 1e-4

_CLASSES = [b" \t", b"\n\r", b"aeiou", b"tnsrhdl", b"bcfgjkmpqvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".",
            b",", b"!?", b"'\"", b"|", b"#*$%&", b"<>{}[]()=_/\\;:"]
N_CLASSES = len(_CLASSES) + 2
CLASS = np.full(256, len(_CLASSES), np.int64)
CLASS[128:] = len(_CLASSES) + 1
for _i, _chars in enumerate(_CLASSES):
    CLASS[list(_chars)] = _i
N_STATS = 6
N_FEATURES = N_CLASSES * N_CLASSES + N_STATS


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of all passages of a chunk of rows, and each row's first passage, with the total at the end."""
    w = ta.words(data, offsets)
    n_words = np.diff(w.first)
    n = np.maximum(1, -(-n_words // PASSAGE))
    first = np.concatenate(([0], np.cumsum(n)))
    of_word = first[w.row] + (np.arange(len(w.row)) - w.first[w.row]) // PASSAGE
    total = int(first[-1])
    begins = np.zeros(total, np.int64)
    has_words = np.bincount(of_word, minlength=total) > 0
    lead = np.searchsorted(of_word, np.flatnonzero(has_words))
    begins[has_words] = w.start[lead]
    at_row = first[:-1]
    begins[at_row] = offsets[:-1]
    of_byte = np.repeat(np.arange(total), np.diff(np.append(begins, len(data))))
    kind = CLASS[data]
    same = of_byte[1:] == of_byte[:-1]
    pair = (of_byte[1:] * (N_CLASSES * N_CLASSES) + kind[:-1] * N_CLASSES + kind[1:])[same]
    pairs = np.bincount(pair, minlength=total * N_CLASSES * N_CLASSES).reshape(total, -1)
    length = np.maximum(pairs.sum(1), 1)[:, None]
    count = np.bincount(of_word, minlength=total)
    size = w.end - w.start
    mean = np.bincount(of_word, size, total) / np.maximum(count, 1)
    square = np.bincount(of_word, size * size, total) / np.maximum(count, 1)
    keys = np.sort((of_word.astype(np.uint64) << np.uint64(40)) | (w.hash >> np.uint64(24)))
    new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    distinct = np.bincount((keys[new] >> np.uint64(40)).astype(np.int64), minlength=total) / np.maximum(count, 1)
    stats = np.stack([count / PASSAGE, np.log1p(mean), np.sqrt(np.maximum(square - mean * mean, 0)), distinct,
                      (count == 0).astype(float), np.log1p(np.repeat(n_words, n)) / 10], 1)
    return np.concatenate([np.sqrt(pairs / length), stats], 1).astype(np.float32), first


@dataclass
class Model:
    """Weights by name, and the features' mean and scale."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        x = (x - self.mean) * self.scale
        h = np.tanh(x @ w["encode"] + w["encode_b"])
        t, g = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-np.clip(h @ w["u"], -30, 30)))
        logit = (t * g) @ w["attend"]
        n = np.diff(first)
        top = np.maximum.reduceat(logit, first[:-1])
        e = np.exp(logit - np.repeat(top, n))
        a = e / np.repeat(np.add.reduceat(e, first[:-1]), n)
        z = np.add.reduceat(a[:, None] * h, first[:-1], 0)
        score = 1 / (1 + np.exp(-np.clip(z @ w["score"] + w["score_b"], -30, 30)))
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "score": score}

    def gradients(self, f: dict[str, np.ndarray], first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        w, n = self.weights, np.diff(first)
        d = (f["score"] - y) / len(y)
        dz = d[:, None] * w["score"]
        each = np.repeat(dz, n, 0)
        value = (each * f["h"]).sum(1)
        mean = np.repeat(np.add.reduceat(f["a"] * value, first[:-1]), n)
        d_logit = f["a"] * (value - mean)
        d_gated = d_logit[:, None] * w["attend"]
        dt, dg = d_gated * f["g"] * (1 - f["t"] ** 2), d_gated * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * each + dt @ w["v"].T + dg @ w["u"].T
        dx = dh * (1 - f["h"] ** 2)
        return {"score": f["z"].T @ d, "score_b": np.array(d.sum()), "attend": (f["t"] * f["g"]).T @ d_logit,
                "v": f["h"].T @ dt, "u": f["h"].T @ dg, "encode": f["x"].T @ dx, "encode_b": dx.sum(0)}


def train(x: np.ndarray, first: np.ndarray, y: np.ndarray) -> Model:
    """By Adam, in an order and from weights that are fixed."""
    random = np.random.RandomState(1)
    shapes = {"encode": (N_FEATURES, HIDDEN), "encode_b": (HIDDEN,), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE),
              "attend": (GATE,), "score": (HIDDEN,), "score_b": ()}
    weights = {k: random.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in ("attend", "score") else np.zeros(s)
               for k, s in shapes.items()}
    share = (y.sum() + 0.5) / (len(y) + 1)
    weights["score_b"] = np.array(np.log(share / (1 - share)))
    deviation = x.std(0) if len(x) else np.ones(N_FEATURES)
    model = Model(weights, x.mean(0) if len(x) else np.zeros(N_FEATURES), 1 / np.maximum(deviation, 0.02))
    if len(np.unique(y)) < 2:
        weights["score"] = np.zeros(HIDDEN)
        return model
    m, v = ({k: np.zeros_like(a) for k, a in weights.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(y))
        for at in range(0, len(y), BAGS):
            bags = order[at:at + BAGS]
            rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in bags])
            own = np.concatenate(([0], np.cumsum(np.diff(first)[bags])))
            grads = model.gradients(model.forward(x[rows], own), own, y[bags])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, grad in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad ** 2
                weights[k] = weights[k] * (1 - rate * DECAY) - rate * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def _features(texts: pa.Array) -> pa.Array:
    """Each row's passages as the bytes of a float32 array."""
    data, offsets = ta.buffers(texts)
    out = []
    for a, b in ta.chunks(offsets):
        x, first = passages(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        out += [x[first[i]:first[i + 1]][:SAMPLE_PASSAGES].tobytes() for i in range(b - a)]
    return pa.array(out, pa.binary())


def fit(docs: DataFrame, labels: DataFrame, learns: Column) -> Model:
    """From documents (doc_id, text) and labels (doc_id, quality) where `learns`, an expression of doc_id, holds."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = marks.where(learns).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
            .select("doc_id", "quality", F.arrow_udf(_features, "binary")("text").alias("x")).toPandas().sort_values("doc_id"))
    bags = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in rows["x"]]
    first = np.concatenate(([0], np.cumsum([len(b) for b in bags]))).astype(np.int64)
    x = np.concatenate(bags) if bags else np.zeros((0, N_FEATURES), np.float32)
    return train(x, first, (rows["quality"].to_numpy() >= 1).astype(float))


def score(text: Column | str, model: Model) -> Column:
    """The chance of label 1."""
    def scored(texts: pa.Array) -> pa.Array:
        data, offsets = ta.buffers(texts)
        out = np.zeros(len(offsets) - 1)
        for a, b in ta.chunks(offsets):
            x, first = passages(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            out[a:b] = model.forward(x, first)["score"]
        return pa.array(out)

    return F.arrow_udf(scored, "double")(text)
