"""Helpers shared by the training-data operators.

Nothing outside this subpackage imports it.  All helpers are lazy DataFrame
code except `materialize`, `checkpointed` and `connected_components`, which
run jobs and leave their rows in the shared checkpoint folder, so a lost
executor costs a recomputation of one step and never of the whole chain.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one bucket of a distributed ranking; a window task never sorts more in expectation.
RANK_BUCKET_ROWS = 20_000
#: Shares that the rows of a key are dealt into before they meet a value of the whole key.
SHARES = 64

_scratch: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one where it is unset and driver and tasks are one process."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="leafmill-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a narrow table with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a wide table as Parquet to the shared folder and read it back (columnar, compressed)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    scratch(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, path: str) -> None:
    """Remove the folder `path` when the session's process ends."""
    _scratch.append((spark, path))


@atexit.register
def _clean() -> None:
    for spark, path in _scratch:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may be gone; the folder is a scratch folder
            return


class HashTable:
    """Unsigned 64-bit keys -> int32 values for whole arrays; levels of direct slots, collisions go a level down."""

    SIZE = 21

    def __init__(self, entries: dict[int, int]):
        self.keys = np.fromiter(entries.keys(), np.uint64, len(entries))
        self.values = np.fromiter(entries.values(), np.int32, len(entries))
        self.levels: list[tuple[np.uint64, np.ndarray]] = []
        left = np.arange(len(entries))
        while len(left):
            mult = np.uint64((0x9E3779B97F4A7C15 * (2 * len(self.levels) + 1)) % 2**64)
            slots = np.full(1 << self.SIZE, -1, np.int32)
            at = (self.keys[left] * mult) >> np.uint64(64 - self.SIZE)
            slots[at] = left
            self.levels.append((mult, slots))
            left = left[slots[at] != left]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where there is none."""
        out = np.full(len(h), -1, np.int32)
        todo = np.arange(len(h))
        for mult, slots in self.levels:
            got = slots[(h[todo] * mult) >> np.uint64(64 - self.SIZE)]
            hit = (got >= 0) & (self.keys[got] == h[todo])
            out[todo[hit]] = got[hit]
            todo = todo[~hit & (got >= 0)]
            if not len(todo):
                break
        return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the rows that nothing is learned from; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def learning_order(doc_id: str = "doc_id"):
    """A pseudo-random order of rows that depends on the id alone."""
    return F.xxhash64(F.col(doc_id).cast("string"), F.lit("learn"))


def bounded_sample(df: DataFrame, rows: int, doc_id: str = "doc_id") -> DataFrame:
    """The `rows` first rows in `learning_order`: one top-k with per-task heaps, no shuffle of the rest."""
    return df.orderBy(learning_order(doc_id), F.col(doc_id)).limit(rows)


def ranked(df: DataFrame, keys: list[str], classes: list[str], order: list[str], spread: list[str], rows: int, out: str) -> DataFrame:
    """Number the rows of every key from 0 without a task that holds a whole key.

    The order is by the int columns `classes`, then arbitrary but fixed: rows
    of a key and class fall into buckets by a hash of the columns `spread`; a
    bucket's rows are numbered by a window over `order` and shifted by the
    sizes of the buckets before it.  `rows` (of the whole table) sizes buckets.
    """
    buckets = max(1, rows // RANK_BUCKET_ROWS)
    b = df.withColumn("_b", F.pmod(F.xxhash64(*spread, F.lit(7)), F.lit(buckets)).cast("int"))
    part = [*keys, *classes, "_b"]
    sizes = b.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*classes, "_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(c).alias(f"_k_{c}") for c in part], F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    b = b.withColumn("_r", F.row_number().over(Window.partitionBy(*part).orderBy(*order)) - 1)
    cond = F.lit(True)
    for c in part:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return b.join(starts, cond).withColumn(out, (F.col("_start") + F.col("_r")).cast("long")).drop("_b", "_r", "_start", *[f"_k_{c}" for c in part])


def beside(df: DataFrame, key: str, spread: str, part: Column, whole: Callable[[str], Column], out: str) -> DataFrame:
    """`df` with the column `out`: an aggregate of all rows of the row's `key`.

    Rows of a key are dealt by a hash of `spread`: `part` aggregates each share and `whole` combines a key's
    shares, so no task reads more than a share of a key's rows, or more than SHARES rows of a key.  Rows
    without a key are left out.
    """
    dealt = df.withColumn("_s", F.pmod(F.xxhash64(spread), F.lit(SHARES)).cast("int"))
    shares = dealt.groupBy(key, "_s").agg(part.alias("_p"))
    shares = shares.withColumn(out, whole("_p").over(Window.partitionBy(key))).drop("_p")
    return dealt.join(shares, [key, "_s"]).drop("_s")


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, component) for every node of `edges` (a long, b long); component is the smallest node reachable.

    Alternating large-star and small-star steps: every step is a minimum over
    a node's neighbours, whose shares lie in several tasks (`beside`), so a hub
    costs no oversized group and no oversized join partition; the number of
    steps is logarithmic in the longest chain.  Each round is
    checkpointed to the shared folder.  An empty input gives an empty result.
    """
    e = checkpointed(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = beside(both, "u", "v", F.min("v"), F.min, "m").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()
        small = beside(large, "u", "v", F.min("v"), F.min, "m").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = checkpointed(small.where("u <> v").distinct())
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
