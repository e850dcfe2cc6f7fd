"""Sinks: tables, ordered CSV exports, JSON lines with nulls, the partitioned release and its manifest."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import release

#: Records of one part file: a part is digested as one value, so it has to fit in a task.
PART_RECORDS = 200_000

# Columns and order of the exports.
EXPORTS = {
    "registry": (("id", "name", "publisher", "source_type", "status", "usage_tag", "priority", "license", "decision_reason", "publication_year", "landing_url", "evidence_urls", "vetting_date"), ("id",)),
    "ledger": (("source_id", "filename", "status", "usage_tag", "sha256", "size_bytes", "detected_type", "content_type", "url", "local_path", "retrieved_at", "last_verified_at", "detail"), ("source_id", "filename")),
    "pages": (("source_id", "doc", "page_num", "classification", "route", "reason", "text_chars", "word_count", "alnum_ratio", "ink_ratio", "orientation", "usage_tag", "image_path", "thumb_path", "text_path", "rendered_at"), ("source_id", "doc", "page_num")),
    "ocr_quality": (("source_id", "doc", "page_num", "quality_flag", "mean_conf", "word_count", "text_chars", "engine", "engine_version", "dpi", "psm", "ocr_path", "created_at"), ("mean_conf",)),
    "segmentation": (("source_id", "doc", "page_num", "items", "extraction_source", "skipped_reason"), ("source_id", "doc", "page_num")),
    "alignment": (("source_id", "test_doc", "answers_doc", "question_items", "answer_pages", "answer_entries", "matched", "match_rate_pct", "unmatched_questions", "orphan_answers", "inconsistent"), ("source_id", "test_doc")),
}


def rebuild(df: DataFrame, path: str) -> None:
    """Replace a derived table."""
    df.write.mode("overwrite").parquet(path)


#: Folder below a root that holds files as rows; readers of loose files pass over its name.
PACKED = "_packed"


def pack(files: DataFrame, root: str) -> None:
    """Put `files` (path below `root`, content) there as rows of Parquet, which `readers` find like loose files.

    A file of its own costs a folder entry, a rename and a place in the driver's listing whatever it holds;
    small files by the million are too much for all three.
    """
    rows = files.select("path", F.col("content").cast("binary").alias("content"))
    rows.withColumns({"length": F.octet_length("content").cast("long"), "modificationTime": F.current_timestamp()}).write.mode("append").parquet(f"{root}/{PACKED}")


def keyed_table(df: DataFrame, name: str, bucket: str, order: list[str], path: str, buckets: int = 64) -> DataFrame:
    """`df` as the catalog table `name`, bucketed by one column and sorted by `order` in its files, for lookups by key.

    A filter on the bucket column reads one bucket; the rest of the key prunes row groups.
    """
    df.repartition(buckets, bucket).write.mode("overwrite").option("path", path).bucketBy(buckets, bucket).sortBy(*order).saveAsTable(name)
    return df.sparkSession.table(name)


def rebuild_table(df: DataFrame, name: str, by: str, path: str | None = None) -> None:
    """Put the rows of `df` into the catalog table `name`, partitioned by the column `by`, in place of the partitions that they fall into.

    Other partitions stay as they are; the table is made where there is none.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        made = df.write.partitionBy(by)
        (made.option("path", path) if path else made).saveAsTable(name)
        return
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(key, before)


def csv_export(df: DataFrame, path: str, columns: list[str] | tuple[str, ...], order: list[str] | tuple[str, ...]) -> None:
    """CSV with a header, in ordered parts (one where the rows are few), also for no rows; arrays become JSON.

    Columns that `df` lacks are empty.
    """
    types = dict(df.dtypes)
    flat = [F.lit(None).cast("string").alias(c) if c not in types else F.to_json(c).alias(c) if types[c].startswith(("array", "struct", "map")) else F.col(c) for c in columns]
    rows = df.orderBy(*[c for c in order if c in types]).select(*flat)
    if rows.isEmpty():
        df.sparkSession.createDataFrame([(",".join(columns),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    else:
        rows.write.mode("overwrite").csv(path, header=True, escape='"')  # quotes are doubled


def export(df: DataFrame, name: str, path: str) -> None:
    """One of the fixed exports (`EXPORTS`)."""
    csv_export(df, path, *EXPORTS[name])


def jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines that keep nulls; mode append adds to a log."""
    df.write.mode(mode).option("ignoreNullFields", "false").option("maxRecordsPerFile", PART_RECORDS).json(path)


class GateError(RuntimeError):
    """A record fails a check that no quarantine covers; nothing is written."""


def build_release(records: DataFrame, folder: str, version: str, built_at: str) -> dict:
    """Write questions by partition, excluded items, statistics and the manifest to a new folder; the manifest.

    `records` come from `merge_records`.  Fatal records are counted before
    anything is written; a failure after that removes the folder.
    """
    spark = records.sparkSession
    gated = release.gate(release.validate(records)).persist()
    try:
        count = {r["decision"]: r["n"] for r in gated.groupBy("decision").agg(F.count(F.lit(1)).alias("n")).collect()}
        if count.get("fatal"):
            raise GateError(f"{count['fatal']} records fail the gate")
        extra = ("errors", "warnings", "decision")
        included = gated.where("decision = 'include'").withColumn("partition", release.partition_for(F.col("usage_tag")))
        included.drop(*extra).write.option("ignoreNullFields", "false").option("maxRecordsPerFile", PART_RECORDS).partitionBy("partition").json(f"{folder}/questions")
        jsonl(gated.where("decision = 'quarantine'").withColumn("_exclusion_reasons", F.col("errors")).drop(*extra), f"{folder}/excluded")
        statistics = release.stats(included)
        jsonl(statistics.orderBy("stat", F.desc("n"), "first_seen"), f"{folder}/stats")
        statistics = spark.read.schema(statistics.schema).json(f"{folder}/stats")
        small = [text_file(spark, folder, "STATS.md", markdown_stats(statistics, f"Release {version}, built {built_at}")), text_file(spark, folder, "SCHEMA.md", markdown_schema(included.drop(*extra), "Fields of a record"))]
        by = {r["value"]: r["n"] for r in statistics.where("stat = 'by_partition'").collect()}
        if "restricted" in by:
            small.append(text_file(spark, folder, "questions/partition=restricted/_RESTRICTED.txt", RESTRICTED_MARK))
        warned = {r["warning"]: r["n"] for r in release.warning_counts(gated).collect()}
        answered = statistics.where("stat = 'answered_items'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        about = {
            "version": version, "built_at": built_at, "included": count.get("include", 0), "quarantined": count.get("quarantine", 0), "warnings": warned,
            "counts": {"public": by.get("public", 0), "restricted": by.get("restricted", 0), "answered": answered},
        }
        done = manifest(spark, folder, about, small)
        text_file(spark, folder, "manifest.json", json.dumps(done, sort_keys=True, indent=1))
    except BaseException:
        delete_folder(spark, folder)
        raise
    finally:
        gated.unpersist()
    return done


def write_release(records: DataFrame, path: str, version: str, built_at: str) -> dict:
    """`build_release` in a folder beside `path`, which then takes the place of an earlier release by renames; all or nothing.

    Between two renames there is no release at `path`; where readers must never see that, use `publish_release`.
    """
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    done = build_release(records, staging, version, built_at)
    try:
        replace_folder(records.sparkSession, staging, path)
    except BaseException:
        delete_folder(records.sparkSession, staging)
        raise
    return done


#: The file that names the release that holds.
POINTER = "CURRENT"


def publish_release(records: DataFrame, root: str, version: str, built_at: str) -> str:
    """`build_release` in a folder of its own below `root`, made the current release by one pointer file; the folder.

    The pointer is written under another name and renamed over the old one, so a reader finds the
    release before or this one, whole, at any moment; earlier releases stay until they are expired.
    """
    name = f"release-{version}-{uuid.uuid4().hex}"
    build_release(records, f"{root}/{name}", version, built_at)
    put_text(records.sparkSession, f"{root}/{POINTER}", name)
    return f"{root}/{name}"


def current_release(spark: SparkSession, root: str) -> str | None:
    """The folder of the release that holds; None before the first."""
    return f"{root}/{read_text(spark, f'{root}/{POINTER}')}" if POINTER in names(spark, root) else None


def expire_releases(spark: SparkSession, root: str) -> None:
    """Remove every release below `root` but the current one."""
    current = current_release(spark, root)
    for name in names(spark, root):
        if name.startswith("release-") and f"{root}/{name}" != current:
            delete_folder(spark, f"{root}/{name}")


def verify_release(spark: SparkSession, folder: str) -> DataFrame:
    """path, status of every file that is in the release or in its manifest: ok, changed, missing or unlisted.

    Files are read and digested in tasks; the manifest is a line for each of them.
    """
    listed = spark.read.schema("artifacts array<struct<path: string, bytes: long, sha256: string>>").json(f"{folder}/manifest.json", multiLine=True).select(F.explode("artifacts").alias("a")).select("a.*")
    found = artifacts(spark, folder, "[!.]*").where("path <> 'manifest.json'")
    # Spark's readers pass over names that begin with an underscore: those are marks, a handful of lines each
    marks = [r["path"] for r in listed.where(F.element_at(F.split("path", "/"), -1).startswith("_")).select("path").collect()]
    there = [(m, read_text(spark, f"{folder}/{m}").encode()) for m in marks if m.rsplit("/", 1)[-1] in names(spark, f"{folder}/{m}".rsplit("/", 1)[0])]
    found = found.unionByName(spark.createDataFrame([(m, len(data), hashlib.sha256(data).hexdigest()) for m, data in there], found.schema))
    both = listed.withColumnsRenamed({"bytes": "_bytes", "sha256": "_sha"}).join(found, "path", "full")
    same = (F.col("bytes") == F.col("_bytes")) & (F.col("sha256") == F.col("_sha"))
    return both.select("path", F.when(F.col("sha256").isNull(), "missing").when(F.col("_sha").isNull(), "unlisted").when(same, "ok").otherwise("changed").alias("status"))


def stage_log(rows: DataFrame, path: str, batch: str) -> str:
    """Write the rows of a batch beside the log at `path`, where no reader looks; the folder."""
    staged = f"{path}/_{batch}-{uuid.uuid4().hex}"
    jsonl(rows, staged)
    return staged


def append_log(rows: DataFrame, path: str, batch: str) -> bool:
    """Append the rows of `batch` to the JSON lines at `path`, once: a batch that is there already is left as it is (False).

    The rows are written aside and come in by one rename, so a failure leaves nothing that `read_log`
    sees and a repeated batch adds nothing.
    """
    spark = rows.sparkSession
    if f"batch={batch}" in names(spark, path):
        return False
    staged = stage_log(rows, path, batch)
    source, fs = _path(spark, staged)
    if not fs.rename(source, _path(spark, f"{path}/batch={batch}")[0]):
        delete_folder(spark, staged)
        return False
    return True


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all appended batches, with `batch` as text."""
    return spark.read.schema(f"{schema}, batch string").option("basePath", path).json(f"{path}/batch=*")


#: Text of the file that marks a partition which must not leave the house.
RESTRICTED_MARK = "These items come from sources whose licence does not allow redistribution. Keep this partition internal.\n"
#: Rows of one statistic in the Markdown file; the JSON lines have them all.
MARKDOWN_ROWS = 500


def markdown_stats(statistics: DataFrame, title: str) -> str:
    """The statistics as Markdown tables, the largest rows of each."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("stat").orderBy(F.desc("n"), "first_seen"))  # Spark keeps the first rows of each task before it exchanges them
    rows = statistics.withColumn("_nth", nth).where(F.col("_nth") <= MARKDOWN_ROWS).orderBy("stat", "_nth").collect()
    lines = [f"# {title}"]
    for stat in dict.fromkeys(r["stat"] for r in rows):
        lines += ["", f"## {stat.replace('_', ' ')}", "", "| Value | Items |", "|---|--:|", *(f"| {r['value']} | {r['n']} |" for r in rows if r["stat"] == stat)]
    return "\n".join(lines) + "\n"


def markdown_schema(df: DataFrame, title: str) -> str:
    return "\n".join([f"# {title}", "", "| Field | Type |", "|---|---|", *(f"| {f.name} | {f.dataType.simpleString()} |" for f in df.schema)]) + "\n"


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def text_file(spark: SparkSession, folder: str, name: str, text: str) -> dict:
    """One small file, written through Spark's file systems; its line of the manifest."""
    data = text.encode("utf-8")
    target, fs = _path(spark, f"{folder}/{name}")
    out = fs.create(target, True)
    out.write(bytearray(data))
    out.close()
    return {"path": name, "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()}


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    target, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    target, fs = _path(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written under another name and renamed over the one before."""
    folder, name = path.rsplit("/", 1)
    aside = f".{name}-{uuid.uuid4().hex}"
    text_file(spark, folder, aside, text)
    jvm = spark._jvm
    source = jvm.org.apache.hadoop.fs.Path(f"{folder}/{aside}")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri() if source.toUri().getScheme() else source.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(source, jvm.org.apache.hadoop.fs.Path(path), over)


def delete_folder(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder `new` in the place of `path`; what was there is kept aside until that is done."""
    source, fs = _path(spark, new)
    target, _ = _path(spark, path)
    aside, _ = _path(spark, f"{new}.before")
    before = fs.exists(target)
    if before and not fs.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(source, target):
        if before:
            fs.rename(aside, target)
        raise OSError(f"cannot put a release at {path}")
    if before:
        fs.delete(aside, True)


def artifacts(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    """path (below the folder), bytes, sha256 of the files of that pattern; a part file holds PART_RECORDS records at most."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return files.select(F.substring_index("path", f"/{name}/", -1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def manifest(spark: SparkSession, path: str, about: dict, small: list[dict]) -> dict:
    """`about` with every file of the release: the part files, and the small files written beside them."""
    rows = [r.asDict() for r in artifacts(spark, path).collect()]  # a row for each file written
    return about | {"artifacts": sorted(rows + small, key=lambda r: r["path"])}
