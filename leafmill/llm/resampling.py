"""Importance resampling towards a target distribution, over hashed n-grams.

Features of a text are all runs of 1 to `ngrams` consecutive words (letters A-Z
lower-cased), hashed into buckets.  A bucket's gain is the logarithm of how much
more frequent it is in the target than in the corpus; a document's weight is the
mean gain of its features, and Gumbel noise seeded by its id turns the largest
weights into a draw without replacement.

Words are numbered and n-grams are tuples of numbers.  A task keeps a dictionary
word -> id; a batch of texts becomes one array of ids, an n-gram of it the pair
(id of the run before its last word, id of the last word), so distinct n-grams
are found by sorting integers.  The bytes of an n-gram are put together and
hashed once when the task first meets it; after that its bucket is looked up by
its id and the counts of the batch are joined back to it.  Dictionaries are the
tasks' own: a dictionary of the whole corpus would have to be shuffled and joined
to every word of every document, while the buckets' counts, at most `buckets`
numbers of each task, are all that has to meet.  A dictionary that reaches
DICTIONARY words or tuples starts again, which changes no result.

The corpus is read twice: for counts of buckets, and for weights.  Weights are
kept as a narrow table in the shared folder; ranks come from one range exchange
of it (score, id, number of the row), whose partitions are counted, so no task
holds more than a share, whatever scores or ids repeat.

Edge cases.  A null or empty text, or one without a word, has no features, weight
0 and is not drawn.  Of rows that share an id each is a document with the same
noise; ties of score go to the smaller id, null ids first, then to the row
that comes first in the table.  The noise of a null id is that of the empty text.
With an empty target or corpus all gains follow from the smoothing alone.  An
empty table gives no rows.  Columns other than the id and text are left out,
whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

NGRAMS, BUCKETS, SEED = 1, 10_000, "2024"
#: Words that a document needs to be drawn, and the part of those documents that is drawn, in percent.
LEAST_WORDS, PERCENT = 20, 10
#: Entries at which a task's dictionary starts again.
DICTIONARY = 2_000_000
#: Bytes of texts that are cut into words together; one longer text is cut alone.
GROUP_BYTES = 16_000_000

# Bytes of words (digits, small letters and all of the other alphabets) and what capitals become.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def words(column: pa.Array) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """Distinct words of a column of texts, the word of each place, and how many words each text has."""
    column = (column.fill_null("") if column.null_count else column).cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    lengths = np.diff(offsets)
    ends = np.cumsum(lengths)
    data = _LOWER[np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]]
    solid = _WORD[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    first = (ends - lengths)[lengths > 0]
    begins[first] = solid[first]
    places = np.flatnonzero(begins)
    kept = np.cumsum(solid)
    starts = np.append(kept[places] - 1, kept[-1] if len(kept) else 0).astype(np.int64)
    runs = pa.Array.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(starts), pa.py_buffer(data[solid])]).dictionary_encode()
    many = np.diff(np.searchsorted(places, np.append(0, ends)))
    return runs.dictionary, runs.indices.to_numpy().astype(np.int64), many


class Hasher:
    """Buckets of the n-grams of texts, each distinct n-gram hashed once."""

    def __init__(self, ngrams: int, buckets: int):
        self.ngrams, self.buckets = ngrams, buckets
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[bytes, int] = {}  # word -> id
        self.tuples: list[dict[int, int]] = [{} for _ in range(self.ngrams - 1)]  # by length - 2: run before << 32 | last word -> id
        self.text: list[list[bytes]] = [[] for _ in range(self.ngrams)]  # by length - 1: bytes of each id
        self.bucket = [np.zeros(1024, np.int64) for _ in range(self.ngrams)]

    def _new(self, level: int, text: bytes) -> int:
        known, k = self.bucket[level], len(self.text[level])
        if k == len(known):
            self.bucket[level] = known = np.append(known, np.zeros(k, np.int64))
        known[k] = zlib.crc32(text) % self.buckets
        self.text[level].append(text)
        return k

    def features(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length of n-gram the text that each feature is in, and its bucket; then the number of words of each text, as the last pair (many, empty)."""
        if max(map(len, self.text)) > DICTIONARY:
            self._clear()
        distinct, place, many = words(column)
        ids = np.array([self.ids[w] if w in self.ids else self.ids.setdefault(w, self._new(0, w)) for w in distinct.to_pylist()], np.int64)
        run = ids[place] if len(place) else place
        word, text = run, np.repeat(np.arange(len(many)), many)
        yield text, self.bucket[0][run]
        for level in range(1, self.ngrams):
            same = text[level:] == text[: len(text) - level] if len(text) > level else np.zeros(0, bool)
            pair = run[: len(same)] << 32 | word[level : level + len(same)]
            pair = np.where(same, pair, -1)
            values, at = np.unique(pair, return_inverse=True)
            known, made = self.tuples[level - 1], np.full(len(values), -1, np.int64)
            for i, p in enumerate(values.tolist()):
                if p >= 0:
                    if p not in known:
                        known[p] = self._new(level, self.text[level - 1][p >> 32] + b" " + self.text[0][p & 0xFFFFFFFF])
                    made[i] = known[p]
            run = made[at]
            yield text[: len(same)][same], self.bucket[level][run[same]]
        yield many, np.zeros(0, np.int64)


def groups(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Parts of a column of texts of GROUP_BYTES or little more, with the place of the first."""
    size, start, held = pa.compute.binary_length(column).fill_null(0).to_numpy(), 0, 0
    for i, n in enumerate(size.tolist()):
        held += n
        if held >= GROUP_BYTES:
            yield start, column.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < len(size):
        yield start, column.slice(start)


def bucket_counts(texts: DataFrame, text: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket is met in all texts; each task adds up its own, and the sums meet by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = Hasher(ngrams, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in groups(batch.column(0)):
                for _, found in hasher.features(part):
                    held += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select(text).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much more frequent each bucket is in the target, every bucket counted once more than it is met."""
    s, t, k = float(corpus.sum()), float(target.sum()), float(len(corpus))
    return np.floor(1000 * np.log((target + 1.0) * (s + k) / ((corpus + 1.0) * (t + k)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, carry: list[str], text: str = "text", ngrams: int = NGRAMS) -> DataFrame:
    """The columns `carry` of `docs` with n_words, n_features and weight, the floored mean gain of the features."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(ngrams, len(gain))
        for batch in batches:
            for start, part in groups(batch.column(len(carry))):
                n, total = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                *found, (many, _) = hasher.features(part)
                for of, bucket in found:
                    n += np.bincount(of, minlength=len(part))
                    summed = np.append(0, np.cumsum(gain[bucket]))  # features come in the order of the texts
                    total += np.diff(summed[np.searchsorted(of, np.arange(len(part) + 1))])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                cols = [batch.column(i).slice(start, len(part)) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(many), pa.array(n), pa.array(weight)], [*carry, "n_words", "n_features", "weight"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(*carry, text).mapInArrow(weigh, f"{kinds}, n_words long, n_features long, weight long")


def noise(doc_id: str, seed: str = SEED) -> F.Column:
    """floor(-1000 ln(-ln u)): a Gumbel variate whose uniform u comes from the hash of seed and id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(u))).cast("long")


def ranked(scored: DataFrame, order: list[F.Column]) -> DataFrame:
    """`scored` with `_place`, from 0, in a total order: one range exchange, whose partitions are counted."""
    ordered = common.checkpointed(scored.orderBy(*order)).withColumn("_at", F.monotonically_increasing_id())
    part, within = F.shiftright("_at", 33).cast("int"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    total, starts = 0, []
    for r in ordered.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row for each partition
        starts.append((r["part"], total))
        total += r["count"]
    begin = scored.sparkSession.createDataFrame(starts, "_part int, _begin long")
    return ordered.withColumn("_part", part).join(begin, "_part").withColumn("_place", F.col("_begin") + within).drop("_part", "_begin", "_at")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, ngrams: int = NGRAMS, buckets: int = BUCKETS, seed: str = SEED, doc_id: str = "doc_id", target_text: str = "text") -> DataFrame:
    """Every row of `docs` (doc_id, text) as doc_id, n_words, n_features, weight, score, rank: 1.. for those drawn, else null.

    Of the N documents of `least_words` words or more the floor(percent N / 100) with the highest scores are drawn.
    """
    gain = gains(bucket_counts(docs, "text", ngrams, buckets), bucket_counts(target, target_text, ngrams, buckets))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("_row"), "text")
    scored = common.materialize(weights(rows, gain, ["doc_id", "_row"], "text", ngrams), "weights")
    scored = scored.withColumns({"score": F.col("weight") + noise("doc_id", seed), "_long": F.col("n_words") >= least_words})
    drawn = scored.where("_long").count() * percent // 100
    placed = ranked(scored, [F.desc("_long"), F.desc("score"), F.asc("doc_id"), F.asc("_row")])
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.cast("long").alias("rank"))
