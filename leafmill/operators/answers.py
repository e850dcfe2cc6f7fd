"""Answer pages: block labels, entries, canonical blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t

# What answer pages say.
_S = t.SPACE
SECTION = rf"(?iuU)(READING{_S}+AND{_S}+WRITING|MATH){_S}*:{_S}*MODULE{_S}*(\d)"
HEAD = rf"(?iuU)^{_S}*QUESTION{_S}+(\d{{1,3}})\b"
BEST = rf"(?iuU)Choice{_S}+([A-D]){_S}+is{_S}+the{_S}+best{_S}+answer"
CORRECT = rf"(?iuU)correct{_S}+answer{_S}+is{_S}+(?:choice{_S}+)?([A-D])\b"
CORRECT_TEXT = rf"(?iuU)correct{_S}+answer{_S}+is{_S}+([^\n.]{{1,60}})"
HEADER_CHARS, RATIONALE_CHARS, RESET_MAX = 200, 800, 5


def block_label(text: Column) -> Column:
    """RW<d> or M<d> from the head of a page; null without a section header."""
    head = F.substring(text, 1, HEADER_CHARS)
    digit = F.regexp_extract(head, SECTION, 2)
    prefix = F.when(F.upper(F.regexp_extract(head, SECTION, 1)).startswith("READING"), "RW").otherwise("M")
    return F.when(head.rlike(SECTION), F.concat(prefix, digit))


def sections(pages: DataFrame, keys: tuple[str, ...], text: str = "page_text") -> DataFrame:
    """One row for each page: keys, block_label, _entries: an array of entries, parsed within the row (see `entries_of`)."""
    lines = F.transform(t.lines(F.coalesce(F.col(text), F.lit(""))), lambda x: F.struct(x.alias("line"), x.rlike(HEAD).alias("head")))
    rows = pages.select(*keys, block_label(F.col(text)).alias("block_label"), lines.alias("_lines"))
    rows = rows.withColumn("_heads", F.array_compact(F.transform("_lines", lambda x, i: F.when(x["head"], i))))
    whole, heads = F.col("_lines"), F.col("_heads")
    said = lambda some: F.array_join(F.transform(F.filter(some, lambda x: t.strip(x["line"]) != ""), lambda x: x["line"]), "\n")
    raw = F.transform(heads, lambda h, k: F.struct(
        (k + 1).cast("int").alias("entry_seq"), F.regexp_extract(F.get(whole, h)["line"], HEAD, 1).alias("number_label"),
        said(F.slice(whole, h + 2, F.coalesce(F.get(heads, k + 1), F.size(whole)) - h - 1)).alias("body"),
    ))
    found = F.transform("_raw", lambda x: F.struct(
        x["entry_seq"].alias("entry_seq"), x["number_label"].alias("number_label"), t.collapse(x["body"]).alias("flat"),
        F.regexp_extract(x["body"], BEST, 1).alias("best"), F.regexp_extract(x["body"], CORRECT, 1).alias("correct"), F.regexp_extract(x["body"], CORRECT_TEXT, 1).alias("said"),
    ))

    def entry(x: Column) -> Column:  # no group of a form that matches is empty
        best, correct, said = (x[c] != "" for c in ("best", "correct", "said"))
        free = ~best & ~correct
        maths = F.coalesce(F.col("block_label").startswith("M"), F.lit(False))
        flags = F.array_compact(F.array(F.when(free & said, "spr_text_answer"), F.when(free & said & maths, "verify_math_typography"), F.when(free & ~said, "no_answer_found")))
        return F.struct(
            x["entry_seq"].alias("entry_seq"), x["number_label"].alias("number_label"), F.when(best, F.upper(x["best"])).when(correct, F.upper(x["correct"])).alias("correct_choice"),
            F.when(free & said, t.strip(x["said"])).alias("answer_text"), F.substring(x["flat"], 1, RATIONALE_CHARS).alias("rationale"), flags.alias("flags"),
        )

    return rows.withColumn("_raw", raw).withColumn("_found", found).select(*keys, "block_label", F.transform("_found", entry).alias("_entries"))


def entries_of(pages: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The entries of `sections`: keys, entry_seq, block_label, number_label, correct_choice, answer_text, rationale, flags."""
    # the outer form: `explode` itself would add a filter that computes the array once more
    got = pages.select(*keys, "block_label", F.explode_outer("_entries").alias("x")).where("x is not null")
    return got.select(*keys, "x.entry_seq", "block_label", "x.number_label", "x.correct_choice", "x.answer_text", "x.rationale", "x.flags")


def parse_answers(pages: DataFrame, keys: tuple[str, ...], text: str = "page_text") -> DataFrame:
    """One row for each entry of a page, without an exchange (see `entries_of`)."""
    return entries_of(sections(pages, keys, text), keys)


def assign_blocks(numbers: DataFrame, keys: tuple[str, ...], order: str = "pos", number: str = "num") -> DataFrame:
    """`numbers` with block: it grows where a number drops back to RESET_MAX or less."""
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.lag(number).over(w)
    reset = F.coalesce((F.col(number) <= before) & (F.col(number) <= RESET_MAX), F.lit(False))
    return numbers.withColumn("_reset", reset.cast("int")).withColumn("block", F.sum("_reset").over(w).cast("int")).drop("_reset")


def answer_blocks(entries: DataFrame, doc: tuple[str, ...], page: str = "page_num") -> DataFrame:
    """`entries` with block_index: pages with entries whose labels follow each other unchanged share a block.

    Null labels are equal to each other.  The entries of a page share its label, so runs of
    entries are runs of pages, and the entries are parsed and exchanged once.
    """
    w = Window.partitionBy(*doc).orderBy(page, "entry_seq")
    new = ~F.col("block_label").eqNullSafe(F.lag("block_label").over(w)) & (F.row_number().over(w) > 1)
    return entries.withColumn("_new", new.cast("int")).withColumn("block_index", F.sum("_new").over(w).cast("int")).drop("_new")


def first_entries(blocks: DataFrame, doc: tuple[str, ...], page: str = "page_num", every: bool = False) -> DataFrame:
    """The first entry of each number in each block, with canon_pos: its place (from 0) in the document's canonical sequence.

    A number keeps the place of its first entry, as the blocks are tables in order of insertion.
    With `every` later entries of a number stay, without a place.
    """
    once = Window.partitionBy(*doc, "block_index", "number_label").orderBy(page, "entry_seq")
    line = Window.partitionBy(*doc).orderBy("block_index", page, "entry_seq")
    first = F.col("_n") == 1
    marked = blocks.withColumn("_n", F.row_number().over(once)).withColumn("canon_pos", F.when(first, F.sum(first.cast("int")).over(line).cast("int") - 1)).drop("_n")
    return marked if every else marked.where("canon_pos is not null")
