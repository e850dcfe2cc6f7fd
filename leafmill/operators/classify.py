"""Page measurement, classification and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

# The thresholds of the decision ladder.
BLANK_CHARS, BLANK_INK = 20, 0.004
SPARSE_CHARS, SPARSE_INK = 150, 0.010
COVER_PAGE, COVER_CHARS = 2, 350
INDEX_WORDS = 450
ROUTE_CHARS, ROUTE_ALNUM = 200, 0.55
HEAD_CHARS, HEADING_CHARS = 600, 120

# What a page head says, with the text that names each rule in a reason.
ANSWER_HEADS = (r"answer\s+key", r"answer\s+explanations?", r"scoring\s+your")
INDEX_HEADS = (r"table\s+of\s+contents", r"^\s*contents\s*$", r"^\s*index\s*$")


PRINTED = ("_alnum2", "_ink3", "_ink4")


def _says(x: Column, pattern: str) -> Column:
    # (?d): only \n ends a line, as the patterns' authors meant it
    return x.rlike("(?iumdU)" + pattern.replace(r"\s", t.SPACE))


def text_stats(df: DataFrame, text: str = "page_text") -> DataFrame:
    """`df` with text_chars, word_count, alnum_ratio (4 places) and head_text of the stripped text."""
    whole = t.strip(F.coalesce(F.col(text), F.lit("")))
    return df.withColumns({
        "text_chars": F.length(whole).cast("long"),
        "word_count": t.word_count(whole).cast("long"),
        "alnum_ratio": F.round(t.alnum_ratio(whole), 4),
        "head_text": F.substring(whole, 1, HEAD_CHARS),
    })


def orientation(width: Column, height: Column) -> Column:
    return F.when(width > height, "landscape").otherwise("portrait")


def _routed(kind: str, why: Column) -> Column:
    chars, alnum = F.col("text_chars"), F.col("alnum_ratio")
    usable = (chars >= ROUTE_CHARS) & (alnum >= ROUTE_ALNUM)
    number, ratio = chars.cast("string"), F.col("_alnum2")
    detail = (
        F.when(usable, F.concat(F.lit("text layer usable ("), number, F.lit(" chars, alnum "), ratio, F.lit(")")))
        .when(chars < ROUTE_CHARS, F.concat(F.lit("text layer too thin ("), number, F.lit(f" chars < {ROUTE_CHARS}) -> image/OCR path")))
        .otherwise(F.concat(F.lit("text layer looks garbled (alnum "), ratio, F.lit(f" < {ROUTE_ALNUM}) -> image/OCR path")))
    )
    return F.struct(F.lit(kind).alias("classification"), F.when(usable, "text").otherwise("image").alias("route"), F.concat_ws("; ", why, detail).alias("reason"))


def _skipped(kind: str, why: Column) -> Column:
    return F.struct(F.lit(kind).alias("classification"), F.lit("skip").alias("route"), why.alias("reason"))


def printed(df: DataFrame) -> DataFrame:
    """`df` with the ratios as reasons print them, each formatted once."""
    return df.withColumns({"_alnum2": t.fixed("alnum_ratio", 2), "_ink3": t.fixed("ink_ratio", 3), "_ink4": t.fixed("ink_ratio", 4)})


def decision() -> Column:
    """struct<classification, route, reason> from page_num, doc_page_count, text_chars, word_count, alnum_ratio, ink_ratio, head_text and what `printed` adds; the first rule that holds decides."""
    chars, ink = F.col("text_chars"), F.col("ink_ratio")
    number = chars.cast("string")
    head = F.substring(F.col("head_text"), 1, HEAD_CHARS)
    out = F.when((chars <= BLANK_CHARS) & (ink <= BLANK_INK), _skipped("blank", F.concat(F.lit("no text ("), number, F.lit(" chars) and no ink ("), F.col("_ink4"), F.lit(f" <= {BLANK_INK})"))))
    for p in ANSWER_HEADS:
        out = out.when(_says(head, p), _routed("answer_key", F.lit(f"header matches answer pattern /{p}/")))
    out = out.when(_says(F.substring(head, 1, HEADING_CHARS), r"^\s*answers\s*$"), _routed("answer_key", F.lit("standalone ANSWERS heading at page top")))
    for p in INDEX_HEADS:
        # the first pattern that matches names the reason; the word limit holds for all
        out = out.when(_says(head, p) & (F.col("word_count") <= INDEX_WORDS), _skipped("index", F.concat(F.lit(f"header matches index pattern /{p}/ with "), F.col("word_count").cast("string"), F.lit(" words"))))
    cover = F.concat(F.lit("page "), F.col("page_num").cast("string"), F.lit(" of "), F.col("doc_page_count").cast("string"), F.lit(" with sparse text ("), number, F.lit(f" chars < {COVER_CHARS})"))
    out = out.when((F.col("page_num") <= COVER_PAGE) & (chars < COVER_CHARS), _skipped("cover", cover))
    out = out.when(chars >= SPARSE_CHARS, _routed("content", F.concat(F.lit("substantial text ("), number, F.lit(" chars)"))))
    graphic = F.concat(F.lit("little text ("), number, F.lit(" chars) but real ink ("), F.col("_ink3"), F.lit(") suggests scanned/graphic content"))
    out = out.when(ink >= SPARSE_INK, _routed("content", graphic))
    return out.otherwise(_skipped("blank", F.concat(F.lit("near-blank divider: "), number, F.lit(" chars, ink "), F.col("_ink4"))))


def with_page_count(pages: DataFrame) -> DataFrame:
    """`pages` with doc_page_count: documents are counted by their keys alone, so no text is sorted and no long document lands in one task."""
    n = pages.drop("doc_page_count").groupBy(F.col("source_id").alias("_s"), F.col("doc").alias("_d")).agg(F.count(F.lit(1)).alias("doc_page_count"))
    return pages.drop("doc_page_count").join(n, F.col("source_id").eqNullSafe(F.col("_s")) & F.col("doc").eqNullSafe(F.col("_d"))).drop("_s", "_d")


def classify(df: DataFrame) -> DataFrame:
    """`df` (measured pages) with classification, route and reason."""
    return printed(df).withColumn("_d", decision()).withColumns({c: F.col(f"_d.{c}") for c in ("classification", "route", "reason")}).drop("_d", *PRINTED)


def reclassify(pages: DataFrame, counted: bool = False) -> DataFrame:
    """Pages whose class or route changes under the present rules, with the new values; measurements are kept.

    The page count is the number of stored rows of the document; `counted`: doc_page_count says it already.
    """
    new = printed(pages if counted else with_page_count(pages)).withColumn("_d", decision())
    changed = ~(F.col("_d.classification").eqNullSafe(F.col("classification")) & F.col("_d.route").eqNullSafe(F.col("route")))
    out = new.where(changed).withColumns({"old_classification": F.col("classification"), "old_route": F.col("route")})
    return out.withColumns({"classification": F.col("_d.classification"), "route": F.col("_d.route"), "reason": F.concat(F.lit("[reclassified] "), F.col("_d.reason"))}).drop("_d", *PRINTED)
