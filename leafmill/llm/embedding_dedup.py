"""Near-duplicate vectors by sorted projection passes.

A pass gives every vector a word of random-hyperplane bits and orders the
vectors of each label lexicographically by their words.  A window runs over
this order: each vector is compared by exact cosine with its neighbours as
long as they agree in the first bits, which is with CROWD - 1 others at most.
Bits and passes follow the largest label, so that a pair at the threshold
shares a window in no pass with a probability of at most `MISS`, however the
vectors lie.  Equal vectors are one vector with a count beforehand.  A pass
passes on a spanning forest of the pairs it verified; the union of all passes
gives components.  Inside a component every pair is then compared exactly, in
blocks, so all links are counted.

Windows of a fixed number of neighbours lose links where vectors crowd: of
641,500 links of a dense label (mean cosine 0.96) windows of 24 left 260
unfound.  Hence the end of a window where the first bits change, and an exact
way for the rest: dense cones (vectors close to each other, but mostly below
the threshold) make runs longer than the window.  Runs of more than `CROWD`
are measured beforehand and compared block against block; where a label's
crowded runs hold more pairs than the label itself, the label is compared as
one.

Edge cases.  Vectors that are null, empty, zero or hold null or non-finite
values, and rows with a null label or vec_id, link with nothing: n_links 0, component_id their own vec_id, kept true.  Vectors of
different lengths never link; each length of a label is a label of its own.  Repeated
rows count as vectors of their own.  An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .near_dedup import _Forest

#: Twice the vectors that a bucket of evenly spread ones has at most.
WINDOW = 24
BITS = 62
#: Columns of a run of neighbours that agree in the first bits (a bucket).
BUCKET = ["pass", "label", "size", "prefix"]
MISS = 1e-7
BLOCK = 2000
#: A larger bucket is compared in blocks of HEAP rows, in SHARES of them while it is small.
CROWD, HEAP, SHARES = 256, 4000, 8


def prefix_for(rows: int) -> int:
    """Bits that share out `rows` evenly spread vectors into buckets of WINDOW / 2."""
    return min(BITS, math.ceil(max(1.0, math.log2(max(rows, 2) / WINDOW) + 1)))


def passes_for(rows: int, cosine: float, miss: float = MISS) -> int:
    """Passes after which a pair at `cosine` has shared no bucket with probability `miss` at most."""
    agree = 1 - math.acos(cosine) / math.pi
    return max(8, math.ceil(math.log(miss) / math.log(1 - agree ** prefix_for(rows))))


def _planes(passes: int, size: int) -> np.ndarray:
    return np.random.default_rng(7919).normal(size=(size, passes * BITS))


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; null for those that cannot link."""
    for batch in batches:
        out = []
        for v in batch.column("embedding").to_pylist():
            x = None
            if v and None not in v:
                x = np.asarray(v, np.float64)
                top = np.abs(x).max()
                x = x / top if np.isfinite(top) and top > 0 else None
            out.append(None if x is None else (x / math.sqrt(float(x @ x))).tobytes())
        names = [None if b is None else xxhash.xxh3_128_digest(b) for b in out]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary()), pa.array(names, pa.binary())], ["vec_id", "label", "unit", "name"])


def _lengths(units: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length."""
    length = np.array([len(u) for u in units], np.int64)
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        yield at, np.frombuffer(b"".join([units[i] for i in at]), np.float64).reshape(len(at), -1)


def _keys(batches: Iterator[pa.RecordBatch], passes: int) -> Iterator[pa.RecordBatch]:
    weights, size, planes = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64), None, None
    for batch in batches:
        keys = np.zeros((batch.num_rows, passes), np.int64)
        for own, x in _lengths(batch.column("unit").to_pylist()):
            if size != x.shape[1]:
                size, planes = x.shape[1], _planes(passes, x.shape[1])
            for at in range(0, len(x), 256):
                keys[own[at : at + 256]] = ((x[at : at + 256] @ planes) >= 0).reshape(-1, passes, BITS) @ weights
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("rep", "label", "size", "unit")), pa.array(list(keys), pa.list_(pa.int64()))], ["rep", "label", "size", "unit", "keys"])


def _buckets(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Spanning forest of the pairs of each bucket of CROWD rows at most; the rows of a bucket follow each other."""
    tail_unit, tail_run, tail_rep = [], np.empty((0, 4), np.int64), np.empty(0, np.int64)
    for batch in batches:
        unit = tail_unit + batch.column("unit").to_pylist()
        run = np.concatenate([tail_run, np.stack([batch.column(n).to_numpy() for n in BUCKET], axis=1).astype(np.int64)])
        rep = np.concatenate([tail_rep, batch.column("rep").to_numpy()])
        nth = np.cumsum(np.concatenate([[0], (run[1:] != run[:-1]).any(axis=1)]))[: len(rep)]
        forest, a, b = _Forest(len(rep)), [], []
        for own, x in _lengths(unit):
            for d in range(1, len(own)):
                same = np.flatnonzero(nth[own[d:]] == nth[own[:-d]])
                if not len(same):
                    break
                for i in same[np.einsum("ij,ij->i", x[same + d], x[same]) >= cosine].tolist():
                    if forest.join(int(own[i]), int(own[i + d])):
                        a.append(rep[own[i]])
                        b.append(rep[own[i + d]])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        last = np.flatnonzero(nth == nth[-1]) if len(nth) else np.empty(0, np.int64)
        tail_unit, tail_run, tail_rep = [unit[i] for i in last], run[last], rep[last]


def _block_links(table: pa.Table, cosine: float) -> pa.Table:
    """Spanning forest of the links in one block, or between two blocks of a crowded bucket."""
    rep, block = table.column("rep").to_numpy(), table.column("block").to_numpy()
    x = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(rep), -1)
    left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    cluster, edges, other = np.arange(len(rep)), [], x[right].T
    for at in range(0, len(left), 256):
        strip = left[at : at + 256]
        near = x[strip] @ other >= cosine
        for i, row in zip(strip[near.any(axis=1)].tolist(), near[near.any(axis=1)], strict=True):
            hit = right[row]
            hit = hit[cluster[hit] != cluster[i]]
            for j in hit[np.unique(cluster[hit], return_index=True)[1]].tolist():
                cluster[cluster == cluster[j]] = cluster[i]
                edges.append((rep[i], rep[j]))
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _count_links(table: pa.Table, cosine: float) -> pa.Table:
    """Links of each vector of one block, or between two blocks of a component; copies count each."""
    rep, many, block = (table.column(n).to_numpy() for n in ("rep", "copies", "block"))
    x = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(rep), -1)
    links = np.zeros(len(rep), np.int64)
    two = len(np.unique(block)) > 1
    for at in range(0, len(rep), 256):
        near = (x[at : at + 256] @ x.T) >= cosine
        if two:
            near &= block[at : at + 256, None] != block[None, :]
        else:
            near[np.arange(len(near)), np.arange(at, at + len(near))] = False
        links[at : at + 256] = near @ many
    return pa.table({"rep": rep, "links": links})


def _links(keyed: DataFrame, cosine: float, cut: int) -> DataFrame:
    """Edges (a, b) whose components hold every pair of links that shares a bucket.

    keyed: rep long, label long, size int, unit binary, keys array<long>; a bucket is the
    vectors of a label and length whose keys of one pass agree without their last `cut` bits.
    """
    def posted(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.select("rep", "label", "size", *columns, F.posexplode("keys").alias("pass", "key")).withColumn("prefix", F.shiftright("key", cut))

    crowded = posted(keyed).groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > CROWD)
    crowded = common.materialize(crowded, "vectors-crowded")
    thin = posted(keyed, "unit")
    heaps = None
    if not crowded.isEmpty():
        pairs = crowded.groupBy("label", "size").agg(F.sum(F.col("m").cast("double") * F.col("m")).alias("pairs"))
        whole = keyed.groupBy("label", "size").agg(F.count(F.lit(1)).alias("m")).join(pairs, ["label", "size"]).where(F.col("pairs") >= F.col("m").cast("double") * F.col("m")).select("label", "size", "m")
        heap = posted(keyed).join(crowded.join(whole, ["label", "size"], "left_anti"), BUCKET).select("rep", *BUCKET, "m")
        heap = heap.unionByName(keyed.join(whole, ["label", "size"]).select("rep", F.lit(-1).alias("pass"), "label", "size", F.lit(0).cast("long").alias("prefix"), "m"))
        heap = common.materialize(heap, "vectors-heaps")
        seen = heap.groupBy("rep").agg(F.collect_set("pass").alias("seen"))
        thin = posted(keyed.join(seen, "rep", "left"), "unit", "seen").where("seen is null or not (array_contains(seen, -1) or array_contains(seen, pass))").drop("seen")
        blocks = F.greatest(F.ceil(F.col("m") / HEAP), F.least(F.lit(SHARES), F.ceil(F.col("m") / CROWD))).cast("int")
        dealt = heap.withColumn("blocks", blocks).withColumn("block", F.pmod(F.hash("rep"), F.col("blocks"))).select(
            "rep", *BUCKET, "block", F.explode(F.expr("transform(sequence(0, blocks - 1), x -> struct(least(x, block) as i, greatest(x, block) as j))")).alias("tile")
        )
        heaps = dealt.join(keyed.select("rep", "unit"), "rep").groupBy(*BUCKET, "tile").applyInArrow(lambda key, t: _block_links(t, cosine), "a long, b long")
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = thin.repartition(parts, *BUCKET).sortWithinPartitions(*BUCKET, "key", "rep").select("rep", "unit", *BUCKET)
    edges = order.mapInArrow(lambda it: _buckets(it, cosine), "a long, b long")
    return edges if heaps is None else edges.unionByName(heaps)


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for `vectors` (vec_id, embedding, label)."""
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    rows = common.materialize(base.mapInArrow(_prepare, "vec_id long, label long, unit binary, name binary"), "vectors")
    fit = F.col("unit").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    groups = rows.where(fit).groupBy("label", "name").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit"))
    groups = common.materialize(groups.withColumns({"node": F.xxhash64("label", "name"), "size": (F.octet_length("unit") / 8).cast("int")}), "vectors-distinct")
    largest = groups.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 0
    passes, cut = passes_for(largest, cosine), BITS - prefix_for(largest)
    keyed = groups.select(F.col("node").alias("rep"), "label", "size", "unit").mapInArrow(lambda it: _keys(it, passes), "rep long, label long, size int, unit binary, keys array<long>")
    keyed = common.materialize(keyed, "vectors-keys")
    edges = _links(keyed, cosine, cut)
    found = common.connected_components(edges).select(F.col("node"), F.col("component").alias("cluster"))
    member = groups.select("node", "rep", "copies", "unit").join(found, "node")
    many = found.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    least = groups.select("node", "rep").join(found, "node").groupBy("cluster").agg(F.min("rep").alias("component"))
    dealt = member.join(many, "cluster").withColumn("block", F.pmod(F.hash("node"), F.col("blocks"))).select(
        "cluster", F.col("node").alias("rep"), "copies", "block", "unit", F.explode(F.expr("transform(sequence(0, blocks - 1), x -> struct(least(x, block) as i, greatest(x, block) as j))")).alias("tile")
    )
    links = dealt.groupBy("cluster", "tile").applyInArrow(lambda key, t: _count_links(t, cosine), "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))
    of = groups.select("node", "label", "name", "rep", "copies").join(found, "node", "left").join(links.withColumnRenamed("rep", "node"), "node", "left").join(least, "cluster", "left")
    of = of.select(F.col("label").alias("_l"), F.col("name").alias("_n"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"), F.coalesce("component", "rep").alias("_c"))
    out = rows.withColumn("_fit", F.when(fit, F.col("name")))
    out = out.join(of, (out.label == of._l) & (F.col("_fit") == of._n), "left")
    return out.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_c", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
