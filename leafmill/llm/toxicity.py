"""Toxicity scoring with a factorization machine over hashed terms.

A term is a maximal run of letters, lower-cased, or its first `STEMS` letters
(inflected insults share a stem); a text is the set of its hashed terms.
Besides a weight for each term the machine learns a short vector for each, and
the product of two vectors weighs the pair: an insult next to the mention of a
group counts for more than their sum, which weights alone cannot say.

Training is Adam in numpy on a bounded sample of labelled rows (`TRAIN_ROWS`), in
one task: the driver's memory holds the model alone.
All terms of the sample take part, each under its own shrinkage: a term's value
in a text is e^4 / (e^4 + EVIDENCE^4), where e is how many standard errors its
share differs between toxic and clean rows, or, if that is more, how many a
pair that it belongs to differs from what its two terms say (pairs of the
`PAIR_TERMS` terms that vary most, with `PAIR_EVIDENCE` for EVIDENCE).  So words
met by chance are not learned by heart, terms that matter only in company are
kept, and no pair of words needs to be listed.  Texts reach that task as sets
of hashes, never as text.

Edge cases.  Null, empty and letterless texts have no term and get the
intercept's score.  Without labelled rows every score is 0.  A null label or
doc_id is not learned from.  Repeated rows are scored each.  Extra columns are
ignored.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BITS = 18
FACTORS = 4
TRAIN_ROWS = 6000
EVIDENCE, PAIR_EVIDENCE = 5.0, 8.0
PAIR_TERMS = 2048
#: Terms whose value is below this are left out: 2000 of them move a score less than one term with evidence.
LEAST = 0.01
STEMS = (4, 6)
EPOCHS, BATCH = 20, 512
RATE, DECAY = 0.05, 1e-3

_words = re.compile(r"[^\W\d_]+").findall


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct hashed terms of the whole text."""
    if not text:
        return np.empty(0, np.int32)
    words = set(_words(text.lower()))
    for k in STEMS:
        words |= {f"^{w[:k]}" for w in words if w[0] != "^"}
    return np.unique(np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) >> (32 - BITS) for w in words), np.int32, len(words)))


def evidence(texts: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """Standard errors that each term, alone or in its best pair, is away from telling nothing of `y`."""
    bad, good = (np.bincount(np.concatenate([np.empty(0, np.int32), *(t for t, k in zip(texts, y, strict=True) if k == want)]).astype(np.int64), minlength=size) for want in (1, 0))
    p, n_bad, n_good = (bad + good + 0.5) / (len(y) + 1), max(y.sum(), 1), max((1 - y).sum(), 1)
    alone = np.abs(bad / n_bad - good / n_good) / np.sqrt(p * (1 - p) * (1 / n_bad + 1 / n_good))
    alone[bad + good == 0] = 0
    spread = np.where(bad + good > 0, p * (1 - p), 0)
    many = min(PAIR_TERMS, int((spread > 0).sum()))
    if many < 2 or not 0 < y.mean() < 1:
        return alone
    top = np.sort(np.argpartition(-spread, many - 1)[:many])
    column = np.full(size, -1)
    column[top] = np.arange(many)
    x = np.zeros((len(y), many), np.float32)
    for i, t in enumerate(texts):
        c = column[t]
        x[i, c[c >= 0]] = 1
    x -= x.mean(axis=0)
    off = (y - y.mean()).astype(np.float32)
    # what two terms say together beyond each alone, against its spread were the terms independent
    found = np.abs((x * off[:, None]).T @ x)
    scale = np.sqrt(spread[top] * np.sqrt(len(y) * y.mean() * (1 - y.mean())))
    i, j = np.nonzero(np.triu(found >= 0.6 * PAIR_EVIDENCE * scale[:, None] * scale[None, :], 1))
    pair = np.zeros(many)
    for at in range(0, len(i), 500):  # the likely ones again, by the spread that they have
        a, b = i[at : at + 500], j[at : at + 500]
        both = x[:, a] * x[:, b]
        both -= both.mean(axis=0)
        far = np.abs((both * off[:, None]).sum(axis=0)) / np.sqrt(np.maximum((both**2 * (off**2)[:, None]).sum(axis=0), 1e-9))
        np.maximum.at(pair, a, far)
        np.maximum.at(pair, b, far)
    alone[top] = np.maximum(alone[top], pair * EVIDENCE / PAIR_EVIDENCE)
    return alone


class Machine:
    """w0 + sum of w[i] + sum over pairs of <v[i], v[j]>, over the terms of a text."""

    def __init__(self, size: int):
        self.w0 = 0.0
        self.slot = np.zeros(size, np.int32)  # 0: a term that the sample does not know
        self.w = np.zeros(1, np.float32)
        self.v = np.zeros((1, FACTORS), np.float32)

    def raw(self, ids: np.ndarray, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and factor sums of texts given as concatenated slots; n: slots of each."""
        linear, sums, squares = np.zeros(len(n)), np.zeros((len(n), FACTORS)), np.zeros((len(n), FACTORS))
        for lo in range(0, len(n), 512):  # blocks of texts, so that gathered factors stay small
            part = slice(lo, lo + 512)
            full = np.flatnonzero(n[part] > 0) + lo
            if len(full):
                first, last = starts[full[0]], starts[full[-1]] + n[full[-1]]
                at, own = starts[full] - first, ids[first:last]
                v = self.v[own]
                linear[full] = np.add.reduceat(self.w[own], at)
                sums[full] = np.add.reduceat(v, at)
                squares[full] = np.add.reduceat(v * v, at)
        return self.w0 + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def fit(self, texts: list[np.ndarray], y: np.ndarray, seed: int = 5) -> Machine:
        e = evidence(texts, y, len(self.slot)) ** 4
        value = e / (e + EVIDENCE**4)
        known = np.flatnonzero(value >= LEAST)
        self.slot[known] = np.arange(1, len(known) + 1)
        value = np.concatenate([[0.0], value[known]]).astype(np.float32)
        rng = np.random.default_rng(seed)
        w, v = np.zeros(len(known) + 1, np.float32), rng.normal(0, 0.05, (len(known) + 1, FACTORS)).astype(np.float32)
        v[0] = 0
        w0 = np.zeros(1, np.float32)
        rows = [s[s > 0] for s in (self.slot[t] for t in texts)]
        weight = np.sqrt(np.where(y == 1, 1 / max(y.mean(), 1e-9), 1 / max(1 - y.mean(), 1e-9)))  # between balanced and as found
        weight /= weight.mean()
        state = [(x, np.zeros_like(x), np.zeros_like(x)) for x in (w, v, w0)]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(rows))
            for lo in range(0, len(rows), BATCH):
                own = order[lo : lo + BATCH]
                n = np.array([len(rows[i]) for i in own])
                ids, of, starts = np.concatenate([rows[i] for i in own]), np.repeat(np.arange(len(own)), n), np.cumsum(n) - n
                # the machine sees each term at its value
                self.w0, self.w, self.v = float(w0[0]), w * value, v * value[:, None]
                z, sums = self.raw(ids, starts, n)
                g = weight[own] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own]) / len(own)
                each = g[of] * value[ids]
                many = np.bincount(ids, each, len(w))
                grads = (
                    many + DECAY * w,
                    np.stack([np.bincount(ids, each * sums[of, f], len(w)) - many * self.v[:, f] for f in range(FACTORS)], axis=1) + DECAY * v,
                    np.array([g.sum()]),
                )
                step += 1
                for (x, m, s), grad in zip(state, grads, strict=True):
                    m += 0.1 * (grad - m)
                    s += 0.01 * (grad * grad - s)
                    x -= RATE * (1 - epoch / EPOCHS) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-4)
        self.w0, self.w, self.v = float(w0[0]), w * value, v * value[:, None]
        return self

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        rows = [s[s > 0] for s in (self.slot[t] for t in texts)]
        n = np.array([len(r) for r in rows], np.int64)
        ids = np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int32)
        z, _ = self.raw(ids, np.concatenate([[0], np.cumsum(n)])[: len(n)].astype(np.int64), n)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([terms(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32())), batch.column("toxic")], ["terms", "toxic"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The machine fitted to all rows, pickled; no row where no text has a term."""
    texts, y = [], [np.empty(0)]
    for batch in batches:
        column = batch.column("terms")
        values, cuts = column.values.to_numpy(), column.offsets.to_numpy()
        texts += [values[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        y.append(batch.column("toxic").to_numpy().astype(float))
    if not sum(map(len, texts)):
        return
    y = np.concatenate(y)
    order = sorted(range(len(texts)), key=lambda i: (y[i], texts[i].tobytes()))  # the rows' order is not Spark's
    model = Machine(1 << BITS).fit([texts[i] for i in order], y[order])
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine | None:
    """Fit on at most `rows` labelled rows that are not held out; None if there are none.

    Of documents that share an id the first text is learned from, so a repeated id adds no rows.
    """
    sample = common.bounded_sample(labels.where("toxic is not null and doc_id is not null").where(~common.held_out()).select("doc_id", F.col("toxic").cast("int").alias("toxic")), rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    terms_ = texts.select("text", "toxic").mapInArrow(_terms, "terms array<int>, toxic int")
    fitted = terms_.repartition(1).mapInArrow(_fit, "model binary").collect()  # one model or none
    return pickle.loads(fitted[0]["model"]) if fitted else None


def _score(batches: Iterator[pa.RecordBatch], model: Machine | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        s = np.zeros(len(texts))
        if model is not None:
            for at in range(0, len(texts), 256):
                s[at : at + 256] = model.scores([terms(t) for t in texts[at : at + 256]])
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in batch.schema.names), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*batch.schema.names, "score", "predicted"])


def score(docs: DataFrame, model: Machine | None) -> DataFrame:
    """`docs` (with text) and score double, predicted int; columns of those names are replaced."""
    kept = docs.drop("score", "predicted")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", score double, predicted int"
    return kept.mapInArrow(lambda it: _score(it, model), schema)
