"""Token ids in files of Re-Pair grammars, with random access.

`write_ids` puts documents in ascending order of id (one range exchange of the
texts), encodes them with the tokenizer and cuts each task's stream of ids,
between documents, into shards of SHARD_TOKENS ids or little more.  A shard is
compressed by itself: frequent pairs of neighbouring symbols are replaced by
nonterminals, again and again, until no pair is frequent.  A file holds shards
as rows of Parquet, so Spark's committer makes a lost or repeated task harmless:

    part, shard   place of the shard: task of the writing job, number within it
    start         ids of the part before the shard
    n_tokens      ids of the shard
    doc_ids       the documents, in order (null where the id is null)
    image         the shard, little-endian unsigned 32-bit integers:
                  version, vocabulary size V, numbers of rounds R, rules G, symbols S, documents D;
                  R numbers of rules that exist after each round; G left sides; G right sides; G expansion
                  lengths; S symbols; D first symbols; D first ids (both from the start of the shard).
                  A symbol below V is an id, V + k is rule k, whose sides are ids or earlier rules.

No rule crosses the end of a document, so a document is a run of symbols.
`read_ids` gives whole documents back; `Shard.slice` decodes any range of ids
alone: expansion lengths lead to the symbols that it touches.

How pairs are replaced.  A turn of textbook Re-Pair replaces the one most
frequent pair.  Here a round replaces at once every occurrence of a pair that is
more frequent than the pairs that overlap it (of equals, the left one), which the
textbook would do in some order as well; what loses to a neighbour waits for the
next round.  Occurrences are counted by a hash of the pair, another one in each
round, and a pair becomes a rule only if LEAST of its own occurrences were picked.

Edge cases.  Null and empty texts are the end mark alone.  Null ids come first.
Rows that share an id are documents of their own, in a fixed order.  A very long
document is one shard; a task holds one Arrow batch and one shard.  An empty table
gives no rows.  Columns other than doc_id and text are left out, whatever their names.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, packing

VERSION = 1
#: Ids from which a shard is closed at the next end of a document.
SHARD_TOKENS = 1 << 19
#: Occurrences that make a pair a rule: a rule costs three numbers, each use saves one.
LEAST = 4
#: Rounds end when one saves less than this part of the symbols, or no pair is frequent.
ENOUGH = 256
#: Slots of the hash under which pairs are counted, as a power of two.
SLOT_BITS = 18
SHARDS = "part int, shard int, start long, n_tokens long, doc_ids array<long>, image binary"


def compress(ids: np.ndarray, first: np.ndarray, size: int, least: int = LEAST) -> bytes:
    """The image of a shard: `ids` of documents that begin at the places `first`, in a vocabulary of `size` ids."""
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)  # the last symbol of a document
    last[np.append(first[1:], len(seq)) - 1] = True
    left, right, length, rounds = [], [], np.zeros(0, np.uint32), []
    none = 1 << SLOT_BITS
    saved = len(seq)
    while len(seq) > 1 and saved * ENOUGH >= len(seq):
        mix = np.uint32(0x9E3779B1 + 2 * len(rounds)), np.uint32(0x85EBCA77 + 2 * len(rounds))  # pairs that share a slot part in the next round
        slot = seq[:-1] * mix[0] + seq[1:] * mix[1]
        slot = ((slot ^ (slot >> np.uint32(15))) >> np.uint32(32 - SLOT_BITS)).astype(np.int64)
        slot[last[:-1]] = none
        count = np.bincount(slot, minlength=none + 1)
        count[none] = 0
        rank = (count << SLOT_BITS | np.arange(none + 1))[slot]
        pick = rank >= least << SLOT_BITS
        pick[1:] &= rank[1:] > rank[:-1]
        pick[:-1] &= rank[:-1] >= rank[1:]
        at = np.flatnonzero(pick)
        slot = slot[at]
        enough = np.bincount(slot, minlength=none)[slot] >= least
        at, slot = at[enough], slot[enough]
        pair = seq[at].astype(np.int64) << 32 | seq[at + 1]
        of = np.zeros(none, np.int64)
        of[slot] = pair
        hit = of[slot] == pair
        at, slot = at[hit], slot[hit]
        chosen = np.bincount(slot, minlength=none) >= least
        hit = chosen[slot]
        at, slot, rules = at[hit], slot[hit], of[chosen]
        if not len(rules):
            break
        seq[at] = (size + len(length) + (np.cumsum(chosen) - 1)[slot]).astype(np.uint32)
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last, saved = seq[keep], last[keep], len(at)
        sides = (rules >> 32).astype(np.uint32), (rules & 0xFFFFFFFF).astype(np.uint32)
        left.append(sides[0]), right.append(sides[1])
        spans = np.append(length, np.uint32(1))  # an id stands for itself
        length = np.append(length, sum(spans[np.where(s < size, -1, s.astype(np.int64) - size)] for s in sides)).astype(np.uint32)
        rounds.append(len(length))
    begin = np.append(0, np.flatnonzero(last)[:-1] + 1) if len(seq) else np.zeros(0, np.int64)
    head = np.array([VERSION, size, len(rounds), len(length), len(seq), len(first), *rounds], np.uint32)
    return b"".join(x.astype("<u4").tobytes() for x in (head, *left, *right, length, seq, begin, first))


class Shard:
    """A shard's image, and ids out of it."""

    def __init__(self, image: bytes):
        data = np.frombuffer(image, "<u4")
        version, self.size, rounds, rules, symbols, docs = (int(x) for x in data[:6])
        if version != VERSION:
            raise ValueError(f"unknown version {version} of a token file")
        cuts = np.cumsum([6, rounds, rules, rules, rules, symbols, docs, docs])
        self.rounds, self.left, self.right, self.length, self.symbols, self.begin, self.first = (data[a:b].astype(np.int64) for a, b in zip(cuts, cuts[1:], strict=False))
        #: How many ids each symbol stands for.
        self.lengths = np.append(np.ones(self.size, np.int64), self.length)
        self._table: tuple[np.ndarray, np.ndarray] | None = None

    def _expand(self, symbols: np.ndarray, flat: np.ndarray, place: np.ndarray) -> np.ndarray:
        n = self.lengths[symbols]
        ends = np.cumsum(n)
        return flat[np.repeat(place[symbols] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]

    def ids(self) -> np.ndarray:
        """All ids: every rule is expanded once, round by round, then the symbols."""
        if self._table is None:
            flat, place = np.arange(self.size, dtype=np.uint32), np.append(np.arange(self.size), self.size + np.cumsum(self.length) - self.length)
            for a, b in zip(np.append(0, self.rounds[:-1]), self.rounds, strict=False):
                flat = np.append(flat, self._expand(np.stack([self.left[a:b], self.right[a:b]], 1).ravel(), flat, place))
            self._table = flat, place
        return self._expand(self.symbols, *self._table)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of the shard: only symbols that reach into the range are followed."""
        symbols = self.symbols
        ends = np.cumsum(self.lengths[symbols])
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        symbols, at = symbols[a:b], int(ends[a - 1]) if a else 0
        while len(rules := np.flatnonzero(symbols >= self.size)):
            n = np.ones(len(symbols), np.int64)
            n[rules] = 2
            to = np.cumsum(n) - n
            out = np.empty(int(n.sum()), np.int64)
            out[to] = symbols
            out[to[rules]], out[to[rules] + 1] = self.left[symbols[rules] - self.size], self.right[symbols[rules] - self.size]
            ends = at + np.cumsum(self.lengths[out])
            c, d = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
            symbols, at = out[c:d], int(ends[c - 1]) if c else at
        return symbols[start - at : stop - at].astype(np.uint32)

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document."""
        stop = int(self.first[k + 1]) if k + 1 < len(self.first) else int(self.lengths[self.symbols].sum())
        return self.slice(int(self.first[k]), stop)


def _shards(batches: Iterator[pa.RecordBatch], tokenizer: str, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    enc = packing.encoder(tokenizer)
    end = packing.END_ID.to_bytes(4, "little")
    size = max(packing.END_ID, *enc.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
    part, number, start = TaskContext.get().partitionId(), 0, 0
    docs, held, tokens = [], [], 0

    def close() -> pa.RecordBatch:
        nonlocal number, start, docs, held, tokens
        many = np.array([len(x) // 4 for x in held], np.int64)
        image = compress(np.frombuffer(b"".join(held), "<u4"), np.cumsum(many) - many, size)
        row = {"part": part, "shard": number, "start": start, "n_tokens": tokens, "doc_ids": docs, "image": image}
        number, start, docs, held, tokens = number + 1, start + tokens, [], [], 0
        types = {"part": pa.int32(), "shard": pa.int32(), "start": pa.int64(), "n_tokens": pa.int64(), "doc_ids": pa.list_(pa.int64()), "image": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in types.items()], list(types))

    for batch in batches:
        for name, ids in zip(batch.column("doc_id").to_pylist(), enc.encode([t or "" for t in batch.column("text").to_pylist()]), strict=True):
            docs.append(name), held.append(ids + end)
            tokens += len(ids) // 4 + 1
            if tokens >= shard_tokens:
                yield close()
    if docs:
        yield close()


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of `docs` (doc_id, text), each document with an end mark, in ascending order of doc_id to token files at `path`.

    A number of the row breaks ties, so rows of one id fall into as many tasks as they need.
    """
    tokenizer = tokenizer or packing.vocabulary()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("_row"))
    ordered = rows.repartitionByRange("doc_id", "_row").sortWithinPartitions("doc_id", "_row").select("doc_id", "text")
    ordered.mapInArrow(lambda it: _shards(it, tokenizer, shard_tokens), SHARDS).write.option("compression", "zstd").parquet(path)


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards at `path`; `start` counts from the first of all ids."""
    found = spark.read.schema(SHARDS).parquet(path)
    total, starts = 0, []
    for r in found.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():  # a row for each task that wrote, so 16 bytes for a range of documents
        starts.append((r["part"], total))
        total += r["n"]
    return found.join(F.broadcast(spark.createDataFrame(starts, "part int, _before long")), "part").withColumn("start", F.col("start") + F.col("_before")).drop("_before")


def _documents(batches: Iterator[pa.RecordBatch], keep_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begins, names, image in zip(batch.column("start").to_pylist(), batch.column("doc_ids"), batch.column("image"), strict=True):
            shard = Shard(image.as_py())
            data = shard.ids().astype("<u4").tobytes()
            cuts = 4 * np.append(shard.first, len(data) // 4)
            parts = [data[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
            cols = {"doc_id": names.values, "start": pa.array(begins + shard.first), "n_tokens": pa.array(np.diff(cuts) // 4), "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64())}
            if keep_ids:
                cols["ids"] = pa.array([np.frombuffer(p, "<i4") for p in parts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def read_ids(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, on demand, ids of every document at `path`."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return shards(spark, path).select("start", "doc_ids", "image").mapInArrow(lambda it: _documents(it, keep_ids), schema)


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """Ids start..stop of the whole collection, as rows (start, ids): only shards that overlap the range, and in them only what it touches."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begins, many, image in zip(batch.column("start").to_pylist(), batch.column("n_tokens").to_pylist(), batch.column("image"), strict=True):
                a, b = max(start - begins, 0), min(stop - begins, many)
                yield pa.RecordBatch.from_arrays([pa.array([begins + a]), pa.array([Shard(image.as_py()).slice(a, b).astype(np.int32)], pa.list_(pa.int32()))], ["start", "ids"])

    touched = shards(spark, path).where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    return touched.select("start", "n_tokens", "image").mapInArrow(cut, "start long, ids array<int>")


def round_trip(docs: DataFrame, tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Write `docs` to token files in the shared folder and read them back."""
    spark = docs.sparkSession
    path = f"{common.shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    common.scratch(spark, path)
    write_ids(docs, path, tokenizer)
    return read_ids(spark, path, keep_ids)
