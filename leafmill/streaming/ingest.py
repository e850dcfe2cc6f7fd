"""Incremental ingestion: new files are upserted into keyed state, once each.

A state is a folder: `v=<batch>/bucket=<b>` holds the rows of a bucket as a
batch left them, and `index/<batch>` says, for every bucket, which version is
its last.  A batch writes its buckets first and its index last, under another
name that is then renamed, so a reader sees a whole batch or none of it; nobody
lists version folders, however many batches there were.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state
from ..sources import writers

#: Parts of the state by a hash of the keys; a batch rewrites those that it touches.
BUCKETS = 256


def ingest(spark: SparkSession, source: str, schema: str, state_path: str, checkpoint: str, keys: list[str], prepare: Callable[[DataFrame], DataFrame] | None = None, buckets: int = BUCKETS, order: tuple[str, ...] = ()) -> None:
    """Read what is new below `source` (Parquet), upsert it into the state below `state_path` and stop.

    The stream's checkpoint remembers which files are done, so running twice
    adds nothing.  Each batch writes a new version, numbered by the batch, of
    the buckets that its keys fall into; a batch that is repeated after a failure
    starts from the index before it and overwrites its own version and index alone.
    Two indexes stay; what only older ones name is removed.  Of rows of one key in
    one batch the largest by `order`, then by all columns, wins.  `buckets` must
    not change in the life of a state.
    """

    def merge(batch: DataFrame, number: int) -> None:
        place = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        new = (prepare(batch) if prepare else batch).withColumn("batch", F.lit(number).cast("long"))
        touched = [r["b"] for r in new.select(place.alias("b")).distinct().collect()]  # `buckets` numbers at most
        if not touched:
            return
        before = _index(spark, state_path, number)
        stored = _read(spark, state_path, {b: v for b, v in before.items() if b in set(touched)})
        # a key twice in one batch: the largest row wins, whatever the order of the files
        rest = sorted(c for c in new.columns if c not in (*keys, "batch", *order))
        rows = new if stored is None else stored.unionByName(new)
        out = state.upsert(rows, keys, ["batch", *order, *rest]).withColumn("bucket", place)
        out.write.mode("overwrite").partitionBy("bucket").parquet(f"{state_path}/v={number}")
        _put_index(spark, state_path, number, {**before, **dict.fromkeys(touched, number)})
        _remove_old(spark, state_path)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(source)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def versions(spark: SparkSession, state_path: str) -> list[int]:
    """Numbers of the batches whose indexes are there: two at most once a batch is done."""
    return sorted(int(n) for n in writers.names(spark, f"{state_path}/index") if n.isdigit())


def _index(spark: SparkSession, state_path: str, below: int | None = None) -> dict[int, int]:
    """Bucket -> version in the last index, or the last below a number."""
    found = [n for n in versions(spark, state_path) if below is None or n < below]
    return {int(b): v for b, v in json.loads(writers.read_text(spark, f"{state_path}/index/{found[-1]}")).items()} if found else {}


def _put_index(spark: SparkSession, state_path: str, number: int, index: dict[int, int]) -> None:
    writers.put_text(spark, f"{state_path}/index/{number}", json.dumps(index, sort_keys=True))


def _remove_old(spark: SparkSession, state_path: str) -> None:
    """Drop indexes but the last two, and the buckets and versions that only those name."""
    *old, last, now = [-1, -1, *versions(spark, state_path)]
    kept = {(b, v) for n in (last, now) if n >= 0 for b, v in json.loads(writers.read_text(spark, f"{state_path}/index/{n}")).items()}
    alive = {v for _, v in kept}
    for n in (n for n in old if n >= 0):
        for b, v in json.loads(writers.read_text(spark, f"{state_path}/index/{n}")).items():
            if v not in alive:
                writers.delete_folder(spark, f"{state_path}/v={v}")
            elif (b, v) not in kept:
                writers.delete_folder(spark, f"{state_path}/v={v}/bucket={b}")
        writers.delete_folder(spark, f"{state_path}/index/{n}")


def _read(spark: SparkSession, state_path: str, index: dict[int, int]) -> DataFrame | None:
    paths = [f"{state_path}/v={v}/bucket={b}" for b, v in sorted(index.items())]
    return spark.read.parquet(*paths) if paths else None


def current(spark: SparkSession, state_path: str) -> DataFrame | None:
    """The last version of every bucket; None where there is none."""
    return _read(spark, state_path, _index(spark, state_path))
