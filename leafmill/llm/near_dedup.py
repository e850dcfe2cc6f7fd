"""MinHash near-duplicate detection: a signature-coordinate inverted join.

Every distinct shingle set gets `ROWS * COORDINATES` min-hash values.  Groups
of `ROWS` of them form one coordinate; a set is posted under each
(coordinate, value) pair of the prefix.  Members of one posting list are
counted against each other on a byte of every min-hash value; pairs at or
above `MATCHES` survive.  What leaves a list is a spanning forest of the
surviving pairs, never the pairs themselves, so a list of n members gives
fewer than n rows.  The forests' components ("clusters") hold every pair that
survived anywhere; inside a cluster full shingle sets are compared exactly.

Skip merging: a posting list longer than `LIST_ROWS` is not counted as it is;
its members are posted again under the list and each of the 36 neighbouring
pairs of their min-hash values.  Two sets at a similarity of 0.8 that share the
list share none of those pairs with probability (1 - 0.64)^36 = 1e-16, so long
lists lose nothing that short ones keep.  Lists that stay long are compared
block by block.

Edge cases.  Null, empty or blank text: no shingles, linked with nothing,
n_shingles 0, kept.  Rows with equal doc_id are one document: each of their
distinct sets is compared, and what one links with, all do.  A null doc_id
never links: component_id null, kept true.  An empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

ROWS, COORDINATES = 3, 24
#: Of ROWS * COORDINATES = 72 values; six standard deviations below the mean at similarity 0.8.
MATCHES = 37
#: Coordinates that are posted: at a similarity of 0.8 two sets share none of them with probability (1 - 0.512)^23 = 7e-8.
PREFIX = COORDINATES - 1
LIST_ROWS = 3000
#: Shingles of one block in the exact comparison, 8 bytes each.
BLOCK_SHINGLES = 300_000

_rng = np.random.default_rng(20240229)
_MULTIPLIERS = (_rng.integers(0, 2**32, ROWS * COORDINATES, dtype=np.uint32) | np.uint32(1))[:, None]
_MIX = _rng.integers(0, 2**63, (COORDINATES, ROWS), dtype=np.uint64) | np.uint64(1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _C
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, words: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    Words are maximal runs of bytes other than ASCII white space, A-Z lower-
    cased; with fewer than `words` words the whole sequence is one shingle.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    take = min(words, len(h))
    n = len(h) - take + 1
    out = np.full(n, np.uint64(take), np.uint64)
    for k in range(take):
        out = _scramble(out * _A + h[k : k + n] * _B)
    return np.unique(out)


def signature(s: np.ndarray) -> np.ndarray:
    """The min-hash values (uint32) of a set that is not empty."""
    low = (s >> np.uint64(32)).astype(np.uint32)
    best = None
    for at in range(0, len(low), 4096):
        m = (low[at : at + 4096] * _MULTIPLIERS).min(axis=1)
        best = m if best is None else np.minimum(best, m)
    return best


def coordinates(values: np.ndarray) -> np.ndarray:
    """One 64-bit posting key for each coordinate; the coordinate's number is part of it."""
    mixed = (values.reshape(COORDINATES, ROWS).astype(np.uint64) * _MIX).sum(axis=1, dtype=np.uint64)
    return _scramble(mixed + np.arange(COORDINATES, dtype=np.uint64) * _A).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, name, coords, sig = [], [], [], []
        for text in batch.column("text").to_pylist():
            s = shingles(text, words)
            n.append(len(s))
            if not len(s):
                name.append(None), coords.append(None), sig.append(None)
                continue
            values = signature(s)
            name.append(xxhash.xxh3_128_digest(s.tobytes()))
            coords.append(coordinates(values))
            sig.append(((values * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("of"), pa.array(n, pa.int64()), pa.array(name, pa.binary()), pa.array(coords, pa.list_(pa.int64())), pa.array(sig, pa.binary())], ["doc_id", "of", "n", "name", "coords", "sig"])


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))
        self.parts = n

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        self.parts -= 1
        return True


def _forest_of_list(table: pa.Table) -> pa.Table:
    """Spanning forest of the pairs of one posting list that share MATCHES values."""
    rep = table.column("rep").to_numpy()
    order = np.argsort(rep, kind="stable")
    rep = rep[order]
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(rep), -1)[order]
    forest, edges = _Forest(len(rep)), []
    for i in range(len(rep) - 1):
        if forest.parts == 1:
            break
        for j in np.flatnonzero((sig[i + 1 :] == sig[i]).sum(axis=1) >= MATCHES).tolist():
            if forest.join(i, i + 1 + j):
                edges.append((rep[i], rep[i + 1 + j]))
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t, words).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("cluster", "rep", "doc", "blocks")), pa.array(sets, pa.binary())], ["cluster", "rep", "doc", "blocks", "set"])


def _exact_links(table: pa.Table, percent: int) -> pa.Table:
    """Spanning forest, as documents, of the exact links of sets in one block, or between two blocks of a cluster."""
    rep = table.column("rep").to_numpy()
    side = table.column("block").to_numpy()
    rep, first = np.unique(rep, return_index=True)
    side, doc = side[first], table.column("doc").to_numpy()[first]
    raw = table.column("set").to_pylist()
    sets = [np.frombuffer(raw[i], np.uint64) for i in first]
    n = np.array([len(s) for s in sets], np.int64)
    flat, _ = np.unique(np.concatenate(sets), return_inverse=True)
    ids = [np.searchsorted(flat, s) for s in sets]
    every, starts = np.concatenate(ids), np.concatenate([[0], np.cumsum(n)[:-1]])
    forest, edges = _Forest(len(rep)), []
    two = len(np.unique(side)) > 1
    mark = np.zeros(len(flat), np.int64)
    for i in np.argsort(-n, kind="stable").tolist():
        if forest.parts == 1:
            break
        mark[ids[i]] = 1
        inter = np.add.reduceat(mark[every], starts)
        mark[ids[i]] = 0
        hit = 100 * inter >= percent * (n + n[i] - inter)
        if two:
            hit &= side != side[i]
        for j in np.flatnonzero(hit).tolist():
            if j != i and forest.join(i, j):
                edges.append((doc[i], doc[j]))
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _lists(postings: DataFrame) -> DataFrame:
    """Size of every posting list with two members or more."""
    return postings.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")


def candidate_forest(reps: DataFrame) -> DataFrame:
    """Edges (a, b) whose components hold every pair of sets that shares MATCHES values.

    reps: rep long, coords array<long>, sig binary; one row per distinct set.
    """
    pairs = reps.select("rep", F.explode(F.slice("coords", 1, PREFIX)).alias("key"))
    lists = _lists(pairs)
    members = common.materialize(pairs.join(lists, "key"), "postings")
    sig = reps.select("rep", "sig")
    twos = F.transform(F.sequence(F.lit(0), F.lit(ROWS * COORDINATES // 2 - 1)), lambda j: F.xxhash64("key", j, F.substring("sig", 2 * j + 1, F.lit(2))))
    again = members.where(F.col("m") > LIST_ROWS).select("key", "rep").join(sig, "rep").select("rep", F.explode(twos).alias("key"))
    deep = again.join(_lists(again), "key")
    short = members.where(F.col("m") <= LIST_ROWS).unionByName(deep.where(F.col("m") <= LIST_ROWS))
    long = deep.where(F.col("m") > LIST_ROWS).withColumn("_nb", F.ceil(F.col("m") / (LIST_ROWS // 2)).cast("int")).withColumn("_b", F.pmod(F.hash("rep"), F.col("_nb")))
    tiles = long.select("rep", F.explode(F.expr("transform(sequence(0, _nb - 1), x -> xxhash64(key, least(x, _b), greatest(x, _b)))")).alias("key"))
    work = short.select("key", "rep").unionByName(tiles.select("key", "rep")).join(sig, "rep")
    return work.groupBy("key").applyInArrow(_forest_of_list, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: near-duplicate components of `docs` (doc_id, text).

    Two documents are linked if 100 * |A and B| >= percent * |A or B| for their
    sets of `words`-word shingles; components follow links transitively.
    `percent` below 80 would need other signature parameters.
    """
    if percent < 80:
        raise ValueError("the signature is sized for similarities of 0.8 or more")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("of", F.xxhash64("text"))
    sketch = common.materialize(base.mapInArrow(lambda it: _sketch(it, words), "doc_id long, of long, n long, name binary, coords array<long>, sig binary"), "sketch")
    named = sketch.where("n > 0 and doc_id is not null")
    names = named.groupBy("name").agg(F.min("doc_id").alias("rep"))
    first = names.select("name", F.col("rep").alias("doc_id"))
    reps = named.join(first, ["name", "doc_id"], "left_semi").dropDuplicates(["name"]).select(F.xxhash64("name").alias("rep"), F.col("doc_id").alias("doc"), "of", "n", "coords", "sig")
    reps = common.materialize(reps, "sets")
    clusters = common.connected_components(candidate_forest(reps)).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    sized = clusters.join(reps.select("rep", "doc", "of", "n"), "rep")
    weight = sized.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    wanted = sized.join(weight, "cluster").withColumnRenamed("of", "text_of")
    sets = base.join(wanted, (base.doc_id == wanted.doc) & (base.of == wanted.text_of)).select("cluster", "rep", "doc", "blocks", "text").mapInArrow(lambda it: _sets(it, words), "cluster long, rep long, doc long, blocks int, set binary")
    dealt = sets.withColumn("block", F.pmod(F.hash("rep"), F.col("blocks"))).select(
        "cluster", "rep", "doc", "block", "set", F.explode(F.expr("transform(sequence(0, blocks - 1), x -> struct(least(x, block) as i, greatest(x, block) as j))")).alias("tile")
    )
    links = dealt.groupBy("cluster", "tile").applyInArrow(lambda key, t: _exact_links(t, percent), "a long, b long")
    shared = named.groupBy("doc_id").agg(F.min("name").alias("x"), F.max("name").alias("y")).where("x <> y").select("doc_id")
    own = named.join(shared, "doc_id", "left_semi").join(names, "name").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = common.connected_components(links.unionByName(own)).select(F.col("node").alias("rep"), "component")
    of = names.join(found, "rep", "left").select("name", F.coalesce("component", "rep").alias("component_id"))
    out = sketch.join(of, "name", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
