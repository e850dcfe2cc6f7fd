"""Tables that several queries start from: written once for a session, read by all of them.

The rows lie in the shared checkpoint folder (`spark.checkpoint.dir`, or a
temporary folder where driver and tasks are one process), so a lost executor
takes nothing with it.  They are removed when the session's process ends.
"""

from __future__ import annotations

import atexit
import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_made: dict[tuple[str, str, str, str], tuple[str, object]] = {}
_paths: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="leafmill-")
    path = f"{named.rstrip('/')}/derived-{uuid.uuid4().hex}"
    _paths.append((spark, path))
    return path


def table_name() -> str:
    """A name in the session's catalog that nothing has yet."""
    return f"derived_{uuid.uuid4().hex}"


def inputs(spark: SparkSession, source: str) -> str:
    """A digest of the paths, sizes and times of the files below `source`."""
    root = spark._jvm.org.apache.hadoop.fs.Path(source)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    seen, found = hashlib.sha256(), []
    if fs.exists(root):
        files = fs.listFiles(root, True)
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    seen.update("\n".join(sorted(found)).encode())
    return seen.hexdigest()


def stored(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table `name` derived from the tables at `source`, built on first use in a session and again when files there change."""
    key = (spark.sparkContext.applicationId, source, name, inputs(spark, source))
    if key not in _made:
        df, path = build(), folder(spark)
        df.write.parquet(path)
        _made[key] = (path, df.schema)
    path, schema = _made[key]
    return spark.read.schema(schema).parquet(path)


@atexit.register
def _clean() -> None:
    for spark, path in _paths:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may be gone; the folder is a scratch folder
            return
