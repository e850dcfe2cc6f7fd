"""Keyed state without MERGE: upserts, pending work, change and checksum tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order`: one partially aggregated maximum, no window.

    `rows` is the union of stored and new rows; doing it twice changes nothing.
    """
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*rows.columns)


def merge(stored: DataFrame, new: DataFrame, keys: list[str], batch: str = "batch") -> DataFrame:
    """`stored` with the rows of `new` in place of those with their keys."""
    return upsert(stored.unionByName(new), keys, [batch])


def pending(wanted: DataFrame, done: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Wanted rows that are not done yet; all of them if forced."""
    return wanted if force else wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def pending_files(wanted: DataFrame, done: DataFrame, keys: list[str], paths: list[str], files: DataFrame, force: bool = False) -> DataFrame:
    """Wanted rows that are not done with all their files: a row whose file has vanished is due again.

    done: keys and the columns `paths`, each a path of `files` (path); null is a file that is not there, and ''
    one that need not be (a blank page's text is an empty file, which a listing of Spark passes over).
    """
    if force:
        return wanted
    whole = done.select(*keys, F.explode(F.array(*paths)).alias("path")).join(files.select("path").distinct().withColumn("_there", F.lit(True)), "path", "left")
    kept = whole.groupBy(*keys).agg(F.bool_and(F.coalesce("_there", F.col("path") == "", F.lit(False))).alias("_all")).where("_all").select(*keys)
    return wanted.join(kept, keys, "left_anti")


def verified(ledger: DataFrame, files: DataFrame, key: str = "local_path") -> DataFrame:
    """Ledger rows with verified: whether the file is there with the recorded SHA-256."""
    found = files.select(key, F.sha2("content", 256).alias("_sha"))
    return ledger.join(found, key, "left").withColumn("verified", F.coalesce(F.col("_sha") == F.col("sha256"), F.lit(False))).drop("_sha")


def orphans(files: DataFrame, ledger: DataFrame, key: str = "local_path") -> DataFrame:
    """Files that no ledger row names; path separators are normalised."""
    named = ledger.where(F.col(key).isNotNull()).select(F.regexp_replace(key, r"\\", "/").alias(key)).distinct()
    return files.join(named, key, "left_anti")


def changed(old: Column, new: Column) -> Column:
    return ~old.eqNullSafe(new)
