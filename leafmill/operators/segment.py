"""Pages to question items: line predicates, item assembly, status.

A page is one row, so its lines stay an array in that row from the split to the
finished items: neighbours, item bounds and choices are places in the array,
and nothing is exchanged, however the pages are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

# Line forms and limits.
_S, _M = t.SPACE, t.MARK
NOISE = rf"(?U)^{_S}*[.\-_~=·]{{4,}}{_S}*$"
ARABIC = rf"(?U)^{_S}{{0,8}}(\d{{1,3}})[.),]{_S}+({_M}.*)$"
ROMAN = rf"(?U)^{_S}{{0,8}}([IVX]{{1,5}})[.)]{_S}+({_M}.*)$"
ALONE = rf"(?U)^{_S}{{0,8}}(\d{{1,3}}){_S}*[.)]?{_S}*$"
CHOICE = rf"(?U)^{_S}*\(?([A-E])[.)\]]{_S}+({_M}.*)$"
ANSWER_LINE = rf"(?iuU)^{_S}*Ans\b"
SUBPART = rf"(?U)^{_S}*\([a-e]\){_S}+"
INLINE = rf"(?sU)\bA[.)]{_S}+{_M}.*\bB[.)]{_S}+{_M}"
MODULE = rf"(?iuU)^{_S}*module{_S}*$"
STEM_MIN, ROMAN_MIN, NEXT_MIN, ALONE_MAX = 15, 20, 15, 60
CLOSING = ".?!):;\"'"
REVIEW = ("short_stem", "truncated_at_page_end", "lonely_choice", "inline_choices")
OCR_MIN = 70

KEYS = ("source_id", "doc", "page_num")

#: What a stripped line must start with to open an item, or to be noise: a quick test before the forms above.
_OPENS, _RULES = r"(?U)^[\dIVX]", r"^[.\-_~=·]{4}"


def _kept(text: Column) -> Column:
    """array<struct<pos, line, s>> of the lines that are neither blank nor separators; s is the line without space around it."""
    every = F.transform(t.lines(F.coalesce(text, F.lit(""))), lambda x, i: F.struct(i.alias("pos"), x.alias("line"), t.strip(x).alias("s")))
    return F.filter(every, lambda x: (x["s"] != "") & ~(x["s"].rlike(_RULES) & x["line"].rlike(NOISE)))


def _marked(kept: Column) -> Column:
    """`kept` with the label of each line that opens an item and the text after its number, else nulls."""

    def mark(x: Column, i: Column) -> Column:
        line, nxt, before = x["line"], F.get(kept, i + 1)["s"], F.get(kept, i - 1)["s"]
        arabic = line.rlike(ARABIC)
        roman = line.rlike(ROMAN) & (F.length(t.strip(F.regexp_extract(line, ROMAN, 2))) >= ROMAN_MIN)
        alone = (
            line.rlike(ALONE) & (F.regexp_extract(line, ALONE, 1).try_cast("int") <= ALONE_MAX) & nxt.isNotNull() & (F.length(nxt) >= NEXT_MIN)
            & ~nxt.rlike(CHOICE) & ~nxt.rlike(ALONE) & ~F.coalesce(before.rlike(MODULE), F.lit(False))
        )
        found = (
            F.when(arabic, F.struct(F.regexp_extract(line, ARABIC, 1).alias("label"), F.regexp_extract(line, ARABIC, 2).alias("first")))
            .when(roman, F.struct(F.regexp_extract(line, ROMAN, 1).alias("label"), F.regexp_extract(line, ROMAN, 2).alias("first")))
            .when(alone, F.struct(F.regexp_extract(line, ALONE, 1).alias("label"), F.lit(None).cast("string").alias("first")))
        )
        return F.struct(x["pos"].alias("pos"), line.alias("line"), x["s"].alias("s"), F.when(x["s"].rlike(_OPENS), found).alias("start"))

    return F.transform(kept, mark)


def _lines(pages: DataFrame, text: str, keys: tuple[str, ...]) -> DataFrame:
    return pages.select(*keys, _kept(F.col(text)).alias("_kept")).select(*keys, _marked(F.col("_kept")).alias("_lines"))


def _exploded(rows: DataFrame, keys: tuple[str, ...], array: Column) -> DataFrame:
    """A row x for each element; `explode` itself would add a filter that computes the whole array once more."""
    return rows.select(*keys, F.explode_outer(array).alias("x")).where("x is not null")


def segment_lines(pages: DataFrame, text: str = "page_text", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Meaningful lines (not blank, no separators): keys, pos from 0, line, is_start, number_label, first_text."""
    rows = _exploded(_lines(pages, text, keys), keys, F.col("_lines"))
    return rows.select(*keys, "x.pos", "x.line", F.col("x.start").isNotNull().alias("is_start"), F.col("x.start.label").alias("number_label"), F.col("x.start.first").alias("first_text"))


def _part(x: Column, i: Column) -> Column:
    """What a line of an item (the i-th) adds: nothing, a piece of the stem or choice, or a new choice.

    The body of the first line is what follows its number; of a lone number, nothing.
    """
    body = F.when(i == 0, x["start"]["first"]).otherwise(x["line"])
    bare = F.when(i == 0, t.strip(body)).otherwise(x["s"])
    blank = F.coalesce(bare.rlike("^(?i)ans") & body.rlike(ANSWER_LINE), F.lit(False))
    choice = F.coalesce(bare.rlike(r"^[(A-E]") & body.rlike(CHOICE), F.lit(False)) & ~blank
    text = F.when(choice, F.concat(F.regexp_extract(body, CHOICE, 1), F.lit(") "), t.strip(F.regexp_extract(body, CHOICE, 2)))).otherwise(bare)
    return F.struct(blank.alias("blank"), choice.alias("choice"), F.when(~blank, text).alias("part"))


def segment_items(pages: DataFrame, text: str = "page_text", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row for each item: keys, item_seq from 1, number_label, stem, choices, kind, start_line, flags."""
    lines, starts, parts, opens = (F.col(c) for c in ("_lines", "_starts", "_parts", "_opens"))
    rows = _lines(pages, text, keys).withColumn("_starts", F.array_compact(F.transform(lines, lambda x, i: F.when(x["start"].isNotNull(), i))))
    upto = lambda places, k, whole: F.coalesce(F.get(places, k), F.size(whole))
    items = F.transform(starts, lambda s, k: F.struct(
        (k + 1).alias("item_seq"), (k + 1 == F.size(starts)).alias("last"), F.get(lines, s)["start"]["label"].alias("number_label"), F.get(lines, s)["pos"].alias("start_line"),
        F.transform(F.slice(lines, s + 1, upto(starts, k + 1, lines) - s), _part).alias("_parts"),
    ))
    got = _exploded(rows, keys, items).select(*keys, "x.*")
    got = got.withColumn("_opens", F.array_compact(F.transform(parts, lambda p, i: F.when(p["choice"], i))))
    said = lambda some: F.transform(F.filter(some, lambda p: p["part"].isNotNull()), lambda p: p["part"])
    got = got.withColumn("_stem", said(F.slice(parts, 1, upto(opens, F.lit(0), parts))))
    got = got.withColumns({
        "n": F.size(opens),
        "answer_line": F.exists(parts, lambda p: p["blank"]),
        "stem": F.array_join(F.filter("_stem", lambda p: p != ""), " "),
        "choices": F.transform(opens, lambda c, k: t.strip(F.array_join(said(F.slice(parts, c + 1, upto(opens, k + 1, parts) - c)), " "))),
    })
    got = got.withColumn("kind", F.when(F.col("n") > 0, "multiple_choice").when(F.col("answer_line"), "free_response").otherwise("unknown"))
    cut = F.col("last") & (F.col("kind") == "unknown") & (F.col("stem") != "") & ~F.lit(CLOSING).contains(F.substring("stem", -1, 1))
    flags = F.array_compact(F.array(
        F.when(F.col("n") == 1, "lonely_choice"),
        F.when(F.length("stem") < STEM_MIN, "short_stem"),
        F.when(F.col("number_label").rlike("^[IVX]+$"), "roman_numbered"),
        F.when(F.exists("_stem", lambda p: p.startswith("(") & p.rlike(SUBPART)), "has_subparts"),
        F.when((F.col("n") == 0) & (F.contains("stem", F.lit("A.")) | F.contains("stem", F.lit("A)"))) & F.col("stem").rlike(INLINE), "inline_choices"),
        F.when(cut, "truncated_at_page_end"),
    ))
    return got.select(*keys, F.col("item_seq").cast("int").alias("item_seq"), "number_label", "stem", "choices", "kind", "start_line", flags.alias("flags"))


def item_status(flags: Column, extraction_source: Column, ocr_mean_conf: Column) -> Column:
    """ok or needs_review; a missing confidence counts as 0."""
    doubtful = F.arrays_overlap(flags, F.array(*map(F.lit, REVIEW))) | ((extraction_source == "ocr") & (F.coalesce(ocr_mean_conf, F.lit(0.0)) < OCR_MIN))
    return F.when(F.coalesce(doubtful, F.lit(False)), "needs_review").otherwise("ok")


def choose_text(plan: DataFrame) -> DataFrame:
    """`plan` (route, quality_flag) with extraction_source and skip_reason: where a page's text comes from."""
    flag = F.col("quality_flag")
    source = F.when(F.col("route") == "text", "text_layer").when(flag.isin("good", "fair"), "ocr")
    return plan.withColumns({"extraction_source": source, "skip_reason": F.when(source.isNull(), F.when(flag.isNull(), "no_ocr_result").otherwise(F.concat(F.lit("ocr_quality_"), flag)))})


def question_items(pages: DataFrame) -> DataFrame:
    """Item records from pages with page_text, extraction_source, ocr_mean_conf and usage_tag; pages without a source of text give none."""
    about = ("extraction_source", "ocr_mean_conf", "usage_tag")
    out = segment_items(pages.where("extraction_source is not null"), keys=(*KEYS, *about))
    conf = F.when(F.col("extraction_source") == "ocr", F.col("ocr_mean_conf"))
    return out.select(
        F.format_string("%s:%s:p%04d:%d", F.col("source_id"), F.col("doc"), F.col("page_num"), F.col("item_seq")).alias("item_id"),
        *KEYS, "item_seq", "number_label", "kind", "stem", "choices", "flags",
        item_status(F.col("flags"), F.col("extraction_source"), conf).alias("status"), "extraction_source", conf.alias("ocr_mean_conf"), "usage_tag",
    )


def page_report(pages: DataFrame) -> DataFrame:
    """`pages` (page_text, extraction_source) with items: how many each page gives, none without a source of text."""
    marked = pages.withColumn("_kept", _kept(F.when(F.col("extraction_source").isNotNull(), F.col("page_text")))).withColumn("_lines", _marked(F.col("_kept")))
    return marked.withColumn("items", F.size(F.filter("_lines", lambda x: x["start"].isNotNull())).cast("long")).drop("_kept", "_lines")
