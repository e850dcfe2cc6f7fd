"""Read-only views of the state: filters, pages of rows, totals."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Page sizes and the values a filter accepts.
PAGES_SIZE, ITEMS_SIZE = 48, 25
CLASSES = ("content", "answer_key", "cover", "index", "blank")
ROUTES = ("text", "image", "skip")
KINDS = ("multiple_choice", "free_response", "unknown")
STATUSES = ("ok", "needs_review")


def where_all(**wanted: tuple[str | None, tuple[str, ...] | None]) -> Column:
    """Conjunction of equalities; empty values and values outside the allowed ones are ignored."""
    terms = [F.col(c) == v for c, (v, allowed) in wanted.items() if v and (allowed is None or v in allowed)]
    return reduce(and_, terms, F.lit(True))


def page_of(df: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """Page `number` (from 1) of the ordered rows; numbers out of range mean the first or last page."""
    pages = max(1, -(-df.count() // size))
    return df.orderBy(*order).offset((min(max(1, number), pages) - 1) * size).limit(size)


def beyond(order: list[str], key: tuple, inclusive: bool = False) -> Column:
    """True for rows after `key` in ascending order of the columns `order`, nulls first; a disjunction of comparisons that a scan can use."""
    terms = []
    for i, (c, v) in enumerate(zip(order, key, strict=True)):
        same = [F.col(d).isNull() if w is None else F.col(d) == F.lit(w) for d, w in zip(order[:i], key[:i], strict=True)]
        terms.append(reduce(and_, same, F.col(c).isNotNull() if v is None else F.col(c) > F.lit(v)))
    if inclusive:
        terms.append(reduce(and_, [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in zip(order, key, strict=True)]))
    return reduce(or_, terms)


def seek(df: DataFrame, order: list[str], after: tuple | None, size: int, inclusive: bool = False) -> DataFrame:
    """The `size` rows after the key `after` (the first ones without): a filter and a top-k, whatever the number of rows before."""
    return (df if after is None else df.where(beyond(order, after, inclusive))).orderBy(*order).limit(size)


def page_index(df: DataFrame, order: list[str], size: int, path: str) -> DataFrame:
    """(page, and the columns `order`): the first key of every page of `size` rows, pages from 1.

    The keys alone are sorted and written to `path` once, each with its place in its part; parts are
    counted, so nothing is numbered in one task.  `order` has to be unique.
    """
    spark = df.sparkSession
    df.select(*order).orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    keys = spark.read.parquet(path).withColumns({"_part": F.shiftright("_at", 33), "_nth": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    total, starts = 0, []
    for r in keys.groupBy("_part").count().orderBy("_part").collect():  # a row for each part of the sort
        starts.append((r["_part"], total))
        total += r["count"]
    placed = keys.join(F.broadcast(spark.createDataFrame(starts, "_part long, _before long")), "_part").withColumn("_place", F.col("_before") + F.col("_nth"))
    return placed.where(F.col("_place") % size == 0).select((F.floor(F.col("_place") / size) + 1).alias("page"), *order)


def page_by_index(df: DataFrame, index: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """Page `number` of the rows that `index` was made of; numbers out of range mean the first or last page."""
    last = index.agg(F.max("page")).first()[0]
    if last is None:
        return df.limit(0)
    start = index.where(F.col("page") == min(max(1, number), last)).first()
    return seek(df, order, tuple(start[c] for c in order), size, inclusive=True)


def browse_pages(pages: DataFrame, source: str | None = None, classification: str | None = None, route: str | None = None, number: int = 1) -> DataFrame:
    return page_of(pages.where(where_all(source_id=(source, None), classification=(classification, CLASSES), route=(route, ROUTES))), ["source_id", "doc", "page_num"], number, PAGES_SIZE)


def with_answers(items: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Items with qa_choice, qa_text, qa_block; nulls where nothing is aligned."""
    if answers is None:
        return items.withColumns({c: F.lit(None).cast("string") for c in ("qa_choice", "qa_text", "qa_block")})
    return items.join(answers.select("item_id", F.col("correct_choice").alias("qa_choice"), F.col("answer_text").alias("qa_text"), F.col("answer_block").alias("qa_block")), "item_id", "left")


def browse_items(items: DataFrame, answers: DataFrame | None, source: str | None = None, kind: str | None = None, status: str | None = None, number: int = 1) -> DataFrame:
    rows = items.where(where_all(source_id=(source, None), kind=(kind, KINDS), status=(status, STATUSES)))
    return page_of(with_answers(rows, answers), ["source_id", "doc", "page_num", "item_seq"], number, ITEMS_SIZE)


def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key)


def matrix(df: DataFrame, by: str, column: str, values: tuple[str, ...]) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(column) == v).alias(v) for v in values])


def neighbours(pages: DataFrame) -> DataFrame:
    """`pages` with has_prev, has_next: whether the page before and after is there."""
    from pyspark.sql import Window

    w = Window.partitionBy("source_id", "doc").orderBy("page_num")
    n = F.col("page_num")
    return pages.withColumns({"has_prev": F.coalesce(F.lag(n).over(w) == n - 1, F.lit(False)), "has_next": F.coalesce(F.lead(n).over(w) == n + 1, F.lit(False))})


def totals(pages: DataFrame) -> DataFrame:
    pct = F.round(100.0 * F.count_if(F.col("route") == "text") / F.nullif(F.count(F.lit(1)), F.lit(0))).cast("long")
    return pages.agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("classification") == "content").alias("content"), F.count_if(F.col("classification") == "answer_key").alias("answer_key"), F.count_if(F.col("route") == "image").alias("image"), pct.alias("text_pct"))
