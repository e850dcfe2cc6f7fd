"""Release gate: record checks, quarantine, partitions and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

# What a released record may hold.
REQUIRED = ("item_id", "source_id", "doc", "kind", "status", "usage_tag")
KINDS = ("multiple_choice", "free_response", "unknown")
STATUSES = ("ok", "needs_review")
PUBLIC_TAGS = ("PUBLIC_DOMAIN", "CC_BY_SA_ATTRIBUTION_SHAREALIKE")
RESTRICTED = "RESTRICTED"
QUARANTINE_MARKERS = ("choice(s)", "duplicate choice letters", "answer letter")
UNANSWERED = "_unanswered"


def letters(choices: Column) -> Column:
    return F.transform(F.coalesce(choices, F.array().cast("array<string>")), lambda c: t.strip(F.substring_index(c, ")", 1)))


def _quoted(x: Column) -> Column:
    return F.coalesce(F.concat(F.lit("'"), x, F.lit("'")), F.lit("None"))


def merge_records(items: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Items with page_image and a nested answer, null where none is aligned (or no alignment exists)."""
    image = F.format_string("data/pages/%s/%s/page_%04d.png", F.col("source_id"), F.col("doc"), F.col("page_num"))
    base = items.withColumn("page_image", image)
    shape = "struct<correct_choice:string,answer_text:string,rationale:string,block:string,answers_doc:string,flags:array<string>,consistent:boolean>"
    if answers is None:
        return base.withColumn("answer", F.lit(None).cast(shape))
    a = answers.select("item_id", F.struct("correct_choice", "answer_text", "rationale", F.col("answer_block").alias("block"), "answers_doc", F.col("answer_flags").alias("flags"), "consistent").cast(shape).alias("answer"))
    return base.join(a, "item_id", "left")


def validate(records: DataFrame) -> DataFrame:
    """`records` with errors and warnings, each an array of messages in the order of the checks.

    A null tag is an error like an unknown one.
    """
    n = F.size(F.coalesce("choices", F.array().cast("array<string>")))
    own = letters(F.col("choices"))
    many = F.col("kind") == "multiple_choice"
    picked = F.col("answer.correct_choice")
    page = F.col("page_num").cast("int")
    tag = F.col("usage_tag")
    errors = [F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(f"missing required field: {c}")) for c in REQUIRED]
    errors += [
        F.when(page.isNull() | (page < 1), F.lit("page_num must be a positive integer")),
        F.when(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)), F.concat(F.lit("unknown kind: "), _quoted(F.col("kind")))),
        F.when(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)), F.concat(F.lit("unknown status: "), _quoted(F.col("status")))),
        F.when(many & (n < 2), F.concat(F.lit("multiple_choice with "), n.cast("string"), F.lit(" choice(s)"))),
        F.when(many & (F.size(F.array_distinct(own)) != n), F.lit("duplicate choice letters")),
        F.when((F.coalesce(picked, F.lit("")) != "") & (n > 0) & ~F.array_contains(own, picked), F.concat(F.lit("answer letter "), picked, F.lit(" not among choices"))),
        F.when(~F.coalesce(tag.isin(*PUBLIC_TAGS) | tag.startswith(RESTRICTED), F.lit(False)), F.concat(F.lit("unknown usage tag: "), _quoted(tag))),
    ]
    cut = F.transform(F.filter(F.coalesce("flags", F.array().cast("array<string>")), lambda f: f == "truncated_at_page_end"), lambda f: f)
    warnings = F.array_compact(F.array(F.when(t.strip(F.coalesce("stem", F.lit(""))) == "", F.lit("empty stem")), F.when(F.col("status") == "needs_review", F.lit("needs_review"))))
    return records.withColumns({"errors": F.array_compact(F.array(*errors)), "warnings": F.concat(warnings, cut)})


def partition_for(tag: Column) -> Column:
    return F.when(tag.startswith(RESTRICTED), "restricted").otherwise("public")


def gate(validated: DataFrame) -> DataFrame:
    """`validated` with decision: include, quarantine (every error is about the item's content) or fatal."""
    soft = F.forall("errors", lambda e: F.lit(False) | e.contains(QUARANTINE_MARKERS[0]) | e.contains(QUARANTINE_MARKERS[1]) | e.contains(QUARANTINE_MARKERS[2]))
    return validated.withColumn("decision", F.when(F.size("errors") == 0, "include").when(soft, "quarantine").otherwise("fatal"))


def stats(included: DataFrame) -> DataFrame:
    """Long table (stat, value, n, first_seen, first_item) over included records, in one pass.

    Within a statistic rows rank by n descending, then by the order of first sight: `first_seen` is the
    smallest place (source, document, page, number on the page) of an item that counts, `first_item` its id.
    """
    answered = F.col("answer").isNotNull()
    rows = (
        ("total_items", F.lit("all"), F.lit(True)), ("by_partition", partition_for(F.col("usage_tag")), F.lit(True)), ("by_source", F.col("source_id"), F.lit(True)), ("by_kind", F.col("kind"), F.lit(True)),
        ("by_status", F.col("status"), F.lit(True)), ("by_extraction_source", F.col("extraction_source"), F.lit(True)), ("answered_items", F.lit("all"), answered),
        ("answer_consistency_failures", F.lit("all"), answered & ~F.col("answer.consistent")), ("answered_by_doc", F.when(answered, F.col("doc")).otherwise(UNANSWERED), F.lit(True)),
    )
    each = F.array_compact(F.array(*[F.when(holds, F.struct(F.lit(stat).alias("stat"), value.cast("string").alias("value"))) for stat, value, holds in rows]))
    at = F.struct("source_id", "doc", F.col("page_num").cast("long").alias("page_num"), F.col("item_seq").cast("long").alias("item_seq"))
    seen = F.min(F.struct("at", "item_id"))
    out = included.select(at.alias("at"), "item_id", F.explode(each).alias("s")).groupBy("s.stat", "s.value").agg(F.count(F.lit(1)).alias("n"), seen.alias("_first"))
    return out.select("stat", "value", "n", F.col("_first.at").alias("first_seen"), F.col("_first.item_id").alias("first_item"))


#: Hexadecimal digits of an id's hash that name its bucket at least, and the ids that a bucket holds about; digests meet by DIGITS digits at a time.
DIGITS, BUCKET_IDS = 3, 20_000


def digests(rows: DataFrame, by: str, key: str) -> DataFrame:
    """by, items, sha256: one digest of the ids of each group, whatever their order.

    Ids fall into buckets by their own hash, more of them the more ids there are;
    each bucket's sorted ids are digested, then the digests of 4096 buckets that
    share a prefix, in order, and so on, so no task ever holds a whole group.
    """
    digits = DIGITS
    many = rows.count()
    while BUCKET_IDS * 16**digits < many:
        digits += DIGITS
    level = rows.groupBy(by, F.substring(F.sha2(F.col(key), 256), 1, digits).alias("_bucket")).agg(F.count(F.lit(1)).alias("items"), F.sha2(F.array_join(F.array_sort(F.collect_list(key)), "\n"), 256).alias("sha256"))
    while digits:
        digits -= DIGITS
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_bucket", "sha256"))), lambda x: x["sha256"]), "\n")
        level = level.withColumn("_prefix", F.substring("_bucket", 1, digits)).groupBy(by, "_prefix").agg(F.sum("items").alias("items"), F.sha2(joined, 256).alias("sha256")).withColumnRenamed("_prefix", "_bucket")
    return level.select(by, "items", "sha256")


def warning_counts(validated: DataFrame) -> DataFrame:
    """Warnings over all records, those of excluded ones too."""
    return validated.select(F.explode("warnings").alias("warning")).groupBy("warning").agg(F.count(F.lit(1)).alias("n"))
