"""Language identification by a string kernel.

The blended-spectrum presence kernel of two texts counts the n-grams (n = 1 to
3, of lower-cased code points, other runs than letters read as one space) that
both hold, over the square root of the product of their numbers.  N-grams are
hashed to `BUCKETS`.  Texts are read whole, in windows of `WINDOW` code points
whose margins are averaged by length: presence does not fill up in long texts,
and a foreign passage counts by its length.  A Nyström map on a few landmark texts of each language
turns the kernel into dense features, on which one-versus-rest kernel ridge
regression is solved; both collapse into one matrix from landmarks to
languages, and the landmarks' n-grams with it into one from n-grams to
languages, so a batch of windows is scored by one matrix product.

Training reads a bounded number of rows (`TRAIN_ROWS` of each language; of more
than `LANGUAGES` languages the most frequent ones), whole, with all their
windows.  There are `LANDMARKS` landmarks of each language, fewer of each where
that would be more than `MARKS` in all.  A window's features depend on the landmarks
alone, so the windows of each language are counted, then each task turns its rows'
windows into features and adds them up, each by one over its language's number, to
one matrix of at most MARKS x MARKS: the normal equations of the ridge regression.
Tasks' rows of that matrix meet by their place; the driver gets landmarks and one
sum, never rows.

Edge cases.  Null, empty and letterless texts (numbers and number signs are no letters), and all texts if nothing can be
learned, are `und` with score 0.  A null lang or doc_id is not learned from.
Ties go to the alphabetically first language.  Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

BUCKETS = 8192
TRAIN_ROWS = 300
LANDMARKS = 40
RIDGE = 1e-2
WINDOW = 512
#: Languages that are learned at most.
LANGUAGES = 200
#: Landmarks of all languages together.
MARKS = 2000
UNKNOWN = "und"
#: Parts that the sample is learned in.
TASKS = 16

_letter = regex.compile(r"\p{L}").search
_other = re.compile(r"[\W\d_]+")
_K = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
_SHIFT = np.uint32(32 - 13)


def presence(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(windows, BUCKETS) zeros and ones, and each window's length; no window for a text without letters."""
    if not text or not _letter(text):
        return np.zeros((0, BUCKETS), np.uint8), np.zeros(0)
    c = np.frombuffer(_other.sub(" ", f" {text.lower()} ").encode("utf-32-le", "surrogatepass"), np.uint32)
    many = -(-len(c) // WINDOW)
    bits = np.zeros((many, BUCKETS), np.uint8)
    flat = bits.ravel()
    at = (np.arange(len(c), dtype=np.int64) // WINDOW) * BUCKETS
    h = c * _K[0]
    flat[at + (h >> _SHIFT)] = 1
    for k in (1, 2):
        h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _K[k] + c[k:] * _K[0]
        flat[at[: len(h)] + (h >> _SHIFT)] = 1
    length = np.full(many, WINDOW, np.float64)
    length[-1] = len(c) - WINDOW * (many - 1)
    return bits, length


class Landmarks:
    """Presence rows of chosen windows, and the map from kernel values with them to features."""

    def __init__(self, bits: np.ndarray):
        #: n-gram by landmark, each landmark scaled to length 1
        self.marks = (bits / np.sqrt(np.maximum(bits.sum(axis=1, dtype=np.float64), 1))[:, None]).T
        values, vectors = np.linalg.eigh(self.marks.T @ self.marks)
        good = values > 1e-8 * values.max()
        self.root = vectors[:, good] / np.sqrt(values[good])
        self.grams = np.ascontiguousarray(self.marks @ self.root, np.float32)

    def features(self, bits: np.ndarray) -> np.ndarray:
        """Features of windows: inner products of features are the kernel's values, as far as the landmarks tell."""
        part = bits.astype(np.float32)
        return ((part @ self.grams) / np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1))).astype(np.float64)


class Model:
    def __init__(self, languages: list[str], grams: np.ndarray):
        self.languages = languages
        #: n-gram by language
        self.grams = np.ascontiguousarray(grams, np.float32)

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Margin of each text for each language, and whether the text has a letter."""
        found = [presence(t) for t in texts]
        many = np.array([len(f[1]) for f in found])
        out = np.zeros((len(texts), len(self.languages)))
        if many.any():
            length = np.concatenate([f[1] for f in found])
            rows = []
            for b, _ in found:
                for at in range(0, len(b), 64):
                    part = b[at : at + 64].astype(np.float32)
                    rows.append((part @ self.grams) / np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1)))
            starts = np.concatenate([[0], np.cumsum(many)[:-1]])[many > 0]
            out[many > 0] = np.add.reduceat(np.concatenate(rows) * length[:, None], starts) / np.add.reduceat(length, starts)[:, None]
        return out, many > 0


def solve(landmarks: Landmarks, languages: list[str], mean: np.ndarray, gram: np.ndarray) -> Model:
    """One-versus-rest ridge regression from each language's mean feature, and the sum over languages of their mean outer products.

    Every language weighs the same, however many windows it has.
    """
    y = 2 * np.eye(len(languages)) - 1
    solved = np.linalg.solve(gram + RIDGE * np.eye(len(gram)) * len(languages) / len(gram), mean.T @ y)
    return Model(languages, landmarks.marks @ (landmarks.root @ solved))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many windows each text has."""
    for batch in batches:
        many = [-(-len(_other.sub(" ", f" {t.lower()} ")) // WINDOW) if t and _letter(t) else 0 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(many, pa.int64())], ["lang", "n"])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One window of each text, which one by the text itself, as packed bits."""
    for batch in batches:
        rows, lang = [], []
        for text, name in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            bits = presence(text)[0]
            if len(bits):
                rows.append(np.packbits(bits[zlib.crc32(text.encode("utf-8", "surrogatepass")) % len(bits)]).tobytes())
                lang.append(name)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(lang, pa.string())], ["bits", "lang"])


def _sums(batches: Iterator[pa.RecordBatch], landmarks: Landmarks, many: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """Rows of sums over the windows of the task, each divided by its language's number: features by language, then outer products of all."""
    size = landmarks.root.shape[1]
    names = sorted(many)
    mean, gram = np.zeros((len(names), size)), np.zeros((size, size))
    place = {x: i for i, x in enumerate(names)}
    for batch in batches:
        for text, name in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            bits = presence(text)[0]
            for at in range(0, len(bits), 256):
                f = landmarks.features(bits[at : at + 256])
                mean[place[name]] += f.sum(axis=0) / many[name]
                gram += f.T @ (f / many[name])
    part = TaskContext.get().partitionId()
    rows = np.concatenate([mean, gram])
    for at in range(0, len(rows), 256):
        some = rows[at : at + 256]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(some), dtype=np.int32)), pa.array([part] * len(some), pa.int32()), pa.array([r.tobytes() for r in some], pa.binary())], ["place", "part", "sums"])


def _meet(rows: pa.Table) -> pa.Table:
    """The sum of all tasks' rows of one place, in the order of tasks."""
    rows = rows.sort_by("part")
    total = np.sum([np.frombuffer(b.as_py()) for b in rows.column("sums")], axis=0)
    return pa.table({"place": rows.column("place").slice(0, 1), "part": rows.column("part").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on at most `rows` rows of each language that are not held out; None without any.

    Of rows that share an id and a language the first text is learned from, so a repeated id adds no rows.
    """
    ids = docs.where("lang is not null and doc_id is not null and text is not null").where(~common.held_out()).select("doc_id", "lang")
    many = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang", F.least(F.lit(1.0), 3.0 * rows / F.col("count")).alias("share"))
    # about three times the rows wanted pass the hash, so the window below sorts a bounded number
    drawn = ids.join(F.broadcast(many), "lang").where(F.pmod(common.learning_order(), F.lit(1 << 40)) < F.col("share") * (1 << 40)).select("doc_id", "lang").distinct()
    order = Window.partitionBy("lang").orderBy(common.learning_order(), "doc_id")
    picked = drawn.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= rows).select("doc_id", "lang", "_r")
    texts = docs.select("doc_id", "lang", "text").join(F.broadcast(picked), ["doc_id", "lang"]).groupBy("doc_id", "lang", "_r").agg(F.min("text").alias("text"))
    texts = common.materialize(texts.repartition(TASKS, F.xxhash64("text")), "language-sample")
    found = texts.where(F.col("_r") <= 2 * LANDMARKS).select("text", "lang").mapInArrow(_marks, "bits binary, lang string").toPandas()
    if not len(found):
        return None
    each = max(1, min(LANDMARKS, MARKS // found["lang"].nunique()))
    chosen = found.sort_values(["lang", "bits"], ignore_index=True).groupby("lang").sample(frac=1, random_state=11).groupby("lang").head(each)["bits"]
    landmarks = Landmarks(np.unpackbits(np.frombuffer(b"".join(chosen), np.uint8).reshape(len(chosen), -1), axis=1))
    sample = texts.select("text", "lang")
    windows = sample.mapInArrow(_windows, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0").collect()  # a row for each language
    many = {r["lang"]: r["n"] for r in windows}
    schema = "place int, part int, sums binary"
    met = sample.mapInArrow(lambda it: _sums(it, landmarks, many), schema).groupBy("place").applyInArrow(_meet, schema).collect()  # (MARKS + languages) x MARKS numbers
    rows_ = np.stack([np.frombuffer(r["sums"]) for r in sorted(met, key=lambda r: r["place"])])
    return solve(landmarks, sorted(many), rows_[: len(many)], rows_[len(many) :])


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        names, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        for at in range(0, len(texts) if model is not None else 0, 128):
            margin, some = model.margins(texts[at : at + 128])
            e = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
            names[at : at + 128] = np.where(some, np.array(model.languages, object)[margin.argmax(axis=1)], UNKNOWN)
            score[at : at + 128] = np.where(some, (e / e.sum(axis=1, keepdims=True)).max(axis=1), 0)
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in batch.schema.names), pa.array(names, pa.string()), pa.array(score)], [*batch.schema.names, "lang_pred", "score"])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` (with text) and lang_pred string, score double; columns of those names are replaced."""
    kept = docs.drop("lang_pred", "score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", lang_pred string, score double"
    return kept.mapInArrow(lambda it: _predict(it, model), schema)
