"""Scans: the seed registry, text and recognised-text files, inbox folders, PDF pages behind an adapter."""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import writers

EVIDENCE = T.StructType([T.StructField(n, T.StringType()) for n in ("url", "note", "retrieved")])
COLLECTION = T.StructType([T.StructField("method", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("item_id", T.StringType()), T.StructField("page_url", T.StringType()), T.StructField("owner_signoff", T.StringType())])
SOURCE = T.StructType([
    *(T.StructField(n, T.StringType()) for n in ("id", "name", "publisher", "source_type", "landing_url")), T.StructField("file_urls", T.ArrayType(T.StringType())), T.StructField("publication_year", T.StringType()),
    T.StructField("license", T.StringType()), T.StructField("evidence", T.ArrayType(EVIDENCE)), *(T.StructField(n, T.StringType()) for n in ("status", "usage_tag", "priority", "decision_reason", "notes")), T.StructField("collection", COLLECTION),
])
SEED = T.StructType([T.StructField("vetting_date", T.StringType()), T.StructField("sources", T.ArrayType(SOURCE))])


def seed_sources(spark: SparkSession, path: str) -> DataFrame:
    """The registry's seed document, one row for each source, optional keys null."""
    return spark.read.schema(SEED).json(path, multiLine=True).select("vetting_date", F.explode("sources").alias("s")).select("s.*", "vetting_date")


PACKED_SCHEMA = "path string, content binary, length long, modificationTime timestamp"


def packed(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path (below `root`), content, length, modificationTime of the files that `writers.pack` put there; no rows where there are none."""
    folder = f"{root.rstrip('/')}/{writers.PACKED}"
    if not writers.exists(spark, folder):
        return spark.sql("select '' as path, cast('' as binary) as content, 0L as length, current_timestamp() as modificationTime where false")
    name = fnmatch.translate(pattern).removesuffix(r"\Z").removesuffix(r"\z")
    rows = spark.read.schema(PACKED_SCHEMA).parquet(folder)
    return rows if pattern == "*" else rows.where(F.substring_index("path", "/", -1).rlike(f"^{name}$"))


def files(spark: SparkSession, root: str, pattern: str = "*", modified_after: str | None = None) -> DataFrame:
    """path, content, length, modificationTime of the files below `root`, loose and packed; only the columns that are used are read."""
    loose = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").options(**({"modifiedAfter": modified_after} if modified_after else {})).load(root)
    rows = packed(spark, root, pattern).withColumn("path", F.concat(F.lit(f"{root.rstrip('/')}/"), "path"))
    if modified_after:
        rows = rows.where(F.col("modificationTime") > F.lit(modified_after).cast("timestamp"))
    return loose.select("path", "content", "length", "modificationTime").unionByName(rows)


def text_files(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """path, text of whole files, loose or packed; bytes that are no UTF-8 become U+FFFD."""
    return files(spark, path, pattern).select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def with_text(plan: DataFrame, files: DataFrame) -> DataFrame:
    """`plan` (path) with page_text; a missing file reads as empty."""
    return plan.join(files.withColumnRenamed("text", "page_text"), "path", "left").withColumn("page_text", F.coalesce("page_text", F.lit("")))


#: Bytes from which a file's content is not read: it would not fit into one value.
CONTENT_LIMIT = 1 << 30


def inbox(spark: SparkSession, path: str, pattern: str = "*.[pP][dD][fF]", layout: str = r"([^/]+)/([^/]+)$", modified_after: str | None = None, limit: int = CONTENT_LIMIT) -> DataFrame:
    """folder, name, content, bytes of the PDF files, loose or packed, in an inbox of one folder for each source.

    `layout` finds folder and name in a path; `modified_after` leaves out what was there before a moment.
    Files beyond `limit` bytes are rows without content: their content is never read.
    """
    read = lambda: files(spark, path, pattern, modified_after)
    small = read().where(F.col("length") <= limit).select("path", "content", F.col("length").alias("bytes"))
    large = read().where(F.col("length") > limit).select("path", F.lit(None).cast("binary").alias("content"), F.col("length").alias("bytes"))
    part = lambda n: F.regexp_extract("path", layout, n)
    return small.unionByName(large).select(part(1).alias("folder"), part(2).alias("name"), "content", "bytes")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """path (below `root`), bytes, modified of every packed file and of every loose one that is not empty, from a listing in tasks; no content is read."""
    loose = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = root.rstrip("/").rsplit("/", 1)[-1]
    found = loose.withColumn("path", F.substring_index("path", f"/{name}/", -1)).drop("content").unionByName(packed(spark, root).drop("content"))
    return found.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A table that may not be there yet: its rows, or none."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


PAGE_SCHEMA = "path string, page_num int, width_pt double, height_pt double, page_text string, ink_ratio double"


def pdf_pages(spark: SparkSession, path: str, adapter: Callable[[bytes], Iterator[tuple[int, float, float, str, float]]]) -> DataFrame:
    """Pages of PDF files by an adapter (page_num, width, height, text, ink) from a file's bytes; no PDF library is bundled."""

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, *page) for p, content in zip(batch["path"], batch["content"], strict=True) for page in adapter(bytes(content))]
            yield pd.DataFrame(rows, columns=["path", "page_num", "width_pt", "height_pt", "page_text", "ink_ratio"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(pages, PAGE_SCHEMA)


#: Gray value below which a pixel counts as ink, and the share of each side left off (scans have dark edges).
INK_BELOW, MARGIN = 200, 0.05


#: Bytes of rasters of one shape that are looked at together.
STACK_BYTES = 64_000_000


def ink_ratios(rasters: np.ndarray, width: int) -> np.ndarray:
    """Share of ink in the middle of each of a stack of grayscale rasters (raster x row x stride)."""
    height = rasters.shape[1]
    inner = rasters[:, int(height * MARGIN) : int(height * (1 - MARGIN)), int(width * MARGIN) : int(width * (1 - MARGIN))]
    return (inner < INK_BELOW).mean(axis=(1, 2)) if inner[0].size else np.zeros(len(rasters))


def ink_ratio(gray: bytes, width: int, height: int, stride: int) -> float:
    """`ink_ratios` of one raster."""
    return float(ink_ratios(np.frombuffer(gray, np.uint8)[: stride * height].reshape(1, height, stride), width)[0])


def ink_density(gray: Column, width: Column, height: Column, stride: Column) -> Column:
    """Column of `ink_ratios` over rasters, those of one shape stacked and reduced together; null where the raster is, or is shorter than its shape."""

    @F.pandas_udf("double")
    def density(g: pd.Series, w: pd.Series, h: pd.Series, s: pd.Series) -> pd.Series:
        out = pd.Series(np.nan, index=g.index, dtype="float64")
        shape = pd.DataFrame({"w": w, "h": h, "s": s})[(g.str.len() >= h * s) & (s >= w)]
        for (wide, high, step), rows in shape.groupby(["w", "h", "s"]).groups.items():
            size, many = int(high) * int(step), max(1, STACK_BYTES // max(1, int(high) * int(step)))
            for at in range(0, len(rows), many):
                some = rows[at : at + many]
                stack = np.frombuffer(b"".join(g[some].str.slice(0, size)), np.uint8).reshape(len(some), int(high), int(step))
                out[some] = ink_ratios(stack, int(wide))
        return out.astype(object).where(out.notna(), None)

    return density(gray, width, height, stride)


def page_assets(pages: DataFrame, render: Callable[[bytes, int], tuple[bytes, bytes]], folder: str) -> DataFrame:
    """`pages` (source_id, doc, page_num, content) as rows of files: path, content of each page's image and thumbnail, by an adapter.

    No raster library is bundled; a writer puts the rows where they belong.
    """

    def assets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for source, doc, page, content in zip(batch["source_id"], batch["doc"], batch["page_num"], batch["content"], strict=True):
                for kind, data in zip(("pages", "thumbs"), render(bytes(content), int(page)), strict=True):
                    rows.append((f"{folder}/{kind}/{source}/{doc}/page_{int(page):04d}.png", data))
            yield pd.DataFrame(rows, columns=["path", "content"])

    return pages.select("source_id", "doc", "page_num", "content").mapInPandas(assets, "path string, content binary")


def recognise(images: DataFrame, engine: Callable[[bytes], tuple[str, str]]) -> DataFrame:
    """`images` (source_id, doc, page_num, content) with text and tsv of a recognition engine behind an adapter; error where it fails."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for content in batch["content"]:
                try:
                    rows.append((*engine(bytes(content)), None))
                except RuntimeError as failed:  # what an adapter raises for a page that its engine refuses
                    rows.append((None, None, str(failed)[:200]))
            yield batch[["source_id", "doc", "page_num"]].assign(text=[r[0] for r in rows], tsv=[r[1] for r in rows], error=[r[2] for r in rows])

    return images.select("source_id", "doc", F.col("page_num").cast("long"), "content").mapInPandas(run, "source_id string, doc string, page_num long, text string, tsv string, error string")
