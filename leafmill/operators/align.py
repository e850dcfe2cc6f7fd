"""Alignment of items to answer entries: a monotone, bounded matcher folded over each pair of documents.

A pair of documents is one row: its items in reading order, its canonical
entries, an index of their labels and what the matcher finds stay arrays in it,
so answers, consistency and counts come out of one fold, without a second look
at the pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import answers

# How far ahead a match may lie, how the first one is confirmed, and the flag of items that are not aligned.
WINDOW, LOOKAHEAD, CONFIRM = 10, 3, 2
LEFT_OUT = "short_stem"
RATIONALE_CHARS = 400
TEST_DOC, ANSWERS_DOC = r"^sat-practice-test-(\d+)-digital$", r"^sat-practice-test-(\d+)-answers-digital$"


def doc_pairs(docs: DataFrame) -> DataFrame:
    """(source_id, test_doc, answers_doc) of the test documents whose answers document exists."""
    d = docs.select("source_id", "doc").distinct()
    tests = d.where(F.col("doc").rlike(TEST_DOC)).select("source_id", F.col("doc").alias("test_doc"), F.regexp_extract("doc", TEST_DOC, 1).alias("_n"))
    answers = d.where(F.col("doc").rlike(ANSWERS_DOC)).select("source_id", F.col("doc").alias("answers_doc"), F.regexp_extract("doc", ANSWERS_DOC, 1).alias("_n"))
    return tests.join(answers, ["source_id", "_n"]).select("source_id", "test_doc", "answers_doc")


def hits(items: str, canon: str, index: str) -> Column:
    """For each label of array `items` the place (from 0) in array `canon` that it matches, or -1; `index` maps a label to its places.

    Before the first match only the places of the label are visited, and one
    counts only if enough of the next labels follow it; afterwards a label matches
    within WINDOW places of the cursor.  The state is the cursor (-1 until the
    first match) and the hits, since places behind the cursor are never looked at again.
    """
    near = f"array_position(slice({canon}, {{0}} + 1, {WINDOW}), {{1}})"
    found = near.format("s.p", "l")
    ahead = f"slice({items}, p.i + 2, {LOOKAHEAD})"
    confirmed = f"aggregate({ahead}, named_struct('p', j + 1, 'c', 0), (s, l) -> if({found} > 0, named_struct('p', s.p + cast({found} as int), 'c', s.c + 1), s), s -> s.c)"
    needed = f"least({CONFIRM}, size(filter({ahead}, l -> map_contains_key({index}, l))))"
    lock = f"coalesce(get(filter(try_element_at({index}, p.x), j -> {confirmed} >= {needed}), 0), -1)"
    at = near.format("a.cursor", "p.x")
    follow = f"if({at} > 0, a.cursor + cast({at} as int) - 1, -1)"
    # the lock-in search runs only until it succeeds
    step = f"(a, p) -> transform(array(if(a.cursor < 0, {lock}, {follow})), h -> named_struct('cursor', if(h >= 0, h + 1, a.cursor), 'hits', concat(a.hits, array(h))))[0]"
    return F.expr(f"aggregate(transform({items}, (x, i) -> named_struct('x', x, 'i', i)), named_struct('cursor', -1, 'hits', cast(array() as array<int>)), {step}, a -> a.hits)")


def letters(choices: Column) -> Column:
    """The letters that choices offer."""
    return F.transform(choices, lambda c: F.trim(F.substring_index(c, ")", 1)))


def agrees(correct_choice: Column, offered: Column) -> Column:
    """False only if a letter answer is none of the letters offered."""
    return F.coalesce(correct_choice.isNull() | (F.size(offered) == 0) | F.array_contains(offered, correct_choice), F.lit(True))


def consistent(correct_choice: Column, choices: Column) -> Column:
    """`agrees` for whole choices."""
    return agrees(correct_choice, letters(choices))


def fold(items: DataFrame, entries: DataFrame, pair: tuple[str, ...]) -> DataFrame:
    """One row for each pair of documents that has items or entries, with what the matcher finds.

    items: pair, item_pos (reading order), item_id, number_label and, if any, choices.
    entries: pair, canon_pos (0 onwards; null for an entry whose number came before), number_label and the entry's columns.
    _items holds the numeric items, _hits for each its place in _canon or -1; question_items and answer_entries count all.
    """
    offered = letters(F.coalesce("choices", F.array().cast("array<string>"))) if "choices" in items.columns else F.array().cast("array<string>")
    item = F.when(F.col("number_label").rlike(r"(?U)^\d+$"), F.struct("item_pos", "item_id", "number_label", offered.alias("letters")))
    left = items.groupBy(*pair).agg(F.count(F.lit(1)).alias("question_items"), F.sort_array(F.collect_list(item)).alias("_items"))
    rest = [c for c in entries.columns if c not in (*pair, "canon_pos", "number_label")]
    entry = F.when(F.col("canon_pos").isNotNull(), F.struct("canon_pos", "number_label", *rest))
    # places are given, so sorting never compares more than the first field
    right = entries.groupBy(*pair).agg(F.count(F.lit(1)).alias("answer_entries"), F.sort_array(F.collect_list(entry)).alias("_canon"))
    both = left.join(right, list(pair), "full")
    none = {c: F.coalesce(c, F.array().cast(both.schema[c].dataType)) for c in ("_items", "_canon")}
    both = both.withColumns({**none, "question_items": F.coalesce("question_items", F.lit(0)), "answer_entries": F.coalesce("answer_entries", F.lit(0))})
    both = both.withColumns({"_labels": F.col("_items.number_label"), "_numbers": F.col("_canon.number_label")})
    places = F.expr("map_from_entries(transform(array_distinct(_numbers), x -> struct(x, filter(transform(_numbers, (v, j) -> if(v = x, j, -1)), j -> j >= 0))))")
    return both.withColumn("_index", places).withColumn("_hits", hits("_labels", "_numbers", "_index")).drop("_labels", "_numbers", "_index")


def matches(folded: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row for each numeric item of `fold`: keys, item_id, number_label, canon_pos (null: unmatched), the entry's columns and consistent."""
    flat = folded.select(*keys, "_canon", F.explode(F.arrays_zip("_items", "_hits")).alias("z"))
    flat = flat.select(*keys, F.col("z._items").alias("_i"), F.get("_canon", F.when(F.col("z._hits") >= 0, F.col("z._hits"))).alias("_e"))
    rest = [f for f in folded.schema["_canon"].dataType.elementType.names if f not in ("canon_pos", "number_label")]
    out = flat.select(*keys, "_i.item_id", "_i.number_label", "_e.canon_pos", *[f"_e.{c}" for c in rest], *([agrees(F.col("_e.correct_choice"), F.col("_i.letters")).alias("consistent")] if "correct_choice" in rest else []))
    return out


def align(items: DataFrame, canon: DataFrame, pair: tuple[str, ...]) -> DataFrame:
    """`matches` of the items of pairs and their canonical entries."""
    return matches(fold(items, canon, pair), pair)


def report(folded: DataFrame, pages: DataFrame, pair: tuple[str, ...]) -> DataFrame:
    """Counts for each pair, and one row with null keys for all pairs together.

    question_items, answer_pages, answer_entries (before the first of a number
    is chosen), matched, unmatched_questions, match_rate_pct (half-even),
    orphan_answers (canonical entries without an item), inconsistent.  Everything
    is counted within the rows of `fold`; the pages are counted by their keys.

    pages: a row for each answer page, with the columns `pair`.
    """
    names = ("question_items", "answer_pages", "answer_entries", "canonical", "matched", "unmatched_questions", "inconsistent")
    got = F.filter(F.arrays_zip("_items", "_hits"), lambda z: z["_hits"] >= 0)
    bad = F.filter(got, lambda z: ~agrees(F.get(F.col("_canon"), z["_hits"])["correct_choice"], z["_items"]["letters"]))
    counts = folded.select(*pair, "question_items", "answer_entries", F.size("_canon").alias("canonical"), F.size(got).alias("matched"), (F.size("_items") - F.size(got)).alias("unmatched_questions"), F.size(bad).alias("inconsistent"))
    every = counts.join(pages.groupBy(*pair).agg(F.count(F.lit(1)).alias("answer_pages")), list(pair), "full").select(*pair, *[F.coalesce(F.col(n).cast("long"), F.lit(0)).alias(n) for n in names])
    # each row counts for itself and for the whole; a row of zeros stands for the whole of nothing
    twice = every.withColumn("_whole", F.explode(F.array(F.lit(False), F.lit(True)))).withColumns({k: F.when(~F.col("_whole"), F.col(k)) for k in pair})
    zeros = every.sparkSession.range(1).select(*[F.lit(None).cast(every.schema[k].dataType).alias(k) for k in pair], *[F.lit(0).cast("long").alias(n) for n in names], F.lit(True).alias("_whole"))
    out = twice.unionByName(zeros).groupBy(*pair, "_whole").agg(*[F.sum(n).alias(n) for n in names]).drop("_whole")
    rate = F.bround(100.0 * F.col("matched") / F.greatest(F.col("question_items"), F.lit(1)), 0).cast("long")
    return out.withColumns({"match_rate_pct": rate, "orphan_answers": F.col("canonical") - F.col("matched")}).drop("canonical")


PAIR = ("source_id", "test_no")


def stage(items: DataFrame, pages: DataFrame) -> DataFrame:
    """`fold` of every test document and its answers document, with test_doc, answers_doc and answer_pages.

    items: `question_items`; those with a short stem are left out.
    pages: source_id, doc, page_num, classification, page_text; entries come from the answer_key pages of answers documents alone.
    A pair of documents without items or entries is a row as well.
    """
    number = lambda form: F.regexp_extract("doc", form, 1).alias("test_no")
    tests = items.where(F.col("doc").rlike(TEST_DOC) & ~F.array_contains("flags", LEFT_OUT))
    tests = tests.select("source_id", number(TEST_DOC), F.struct("page_num", "item_seq").alias("item_pos"), "item_id", "number_label", "choices")
    keyed = pages.where(F.col("doc").rlike(ANSWERS_DOC) & (F.col("classification") == "answer_key")).select("source_id", number(ANSWERS_DOC), "page_num", "page_text")
    entries = answers.first_entries(answers.answer_blocks(answers.parse_answers(keyed, (*PAIR, "page_num")), PAIR), PAIR, every=True)
    test, key = F.col("doc").rlike(TEST_DOC), F.col("doc").rlike(ANSWERS_DOC)
    docs = pages.where(test | key).groupBy("source_id", F.when(test, number(TEST_DOC)).otherwise(number(ANSWERS_DOC)).alias("test_no")).agg(
        F.max(F.when(test, F.col("doc"))).alias("test_doc"), F.max(F.when(key, F.col("doc"))).alias("answers_doc"), F.count_if(key & (F.col("classification") == "answer_key")).alias("answer_pages"),
    )
    found = docs.where("test_doc is not null and answers_doc is not null").join(fold(tests, entries, PAIR), list(PAIR), "left")
    some = {c: F.coalesce(c, F.array().cast(found.schema[c].dataType)) for c in ("_items", "_canon", "_hits")}
    return found.withColumns({**some, "question_items": F.coalesce("question_items", F.lit(0)), "answer_entries": F.coalesce("answer_entries", F.lit(0))})


def qa_alignment(staged: DataFrame) -> DataFrame:
    """The answers that `stage` found: a row for each matched item."""
    rows = matches(staged, ("source_id", "test_doc", "answers_doc")).where("canon_pos is not null")
    return rows.select(
        "item_id", "answers_doc", F.col("block_label").alias("answer_block"), "correct_choice", "answer_text",
        F.substring("rationale", 1, RATIONALE_CHARS).alias("answer_rationale"), F.col("flags").alias("answer_flags"), "consistent",
    )
