"""Answer pages and alignment."""

import random

import pytest
from pyspark.sql import functions as F

from leafmill.operators import align, answers

from . import model


def parsed(spark, text):
    rows = answers.parse_answers(spark.createDataFrame([(1, text)], "page int, page_text string"), ("page",)).orderBy("entry_seq").collect()
    return [(r.number_label, r.correct_choice, r.answer_text, r.flags) for r in rows], rows


@pytest.mark.parametrize(
    ("head", "want"),
    [("READING AND WRITING: MODULE 1\nx", "RW1"), ("Math :  module 2", "M2"), ("reading  and\nwriting: MODULE 2", "RW2"), ("x" * 200 + "MATH: MODULE 1", None), ("x" * 180 + "MATH: MODULE 1", "M1"), ("Answers", None), ("", None)],
)
def test_block_label(spark, head, want):
    assert spark.createDataFrame([(head,)], "t string").select(answers.block_label(F.col("t"))).first()[0] == want


def test_entries(spark):
    got, rows = parsed(spark, "READING AND WRITING: MODULE 1\nlost text\nQUESTION 1\nChoice B is the best answer because\nof   the text.\n\nQuestion 2\nThe correct answer is choice d.\nQUESTION 3\nNo statement here.\nQUESTION 4\n")
    assert got == [("1", "B", None, []), ("2", "D", None, []), ("3", None, None, ["no_answer_found"]), ("4", None, None, ["no_answer_found"])]
    assert rows[0].rationale == "Choice B is the best answer because of the text." and rows[3].rationale == ""


def test_text_answers(spark):
    got, _ = parsed(spark, "MATH: MODULE 2\nQUESTION 7\nThe correct answer is 14. Since x.\nQUESTION 8\nThe correct answer is 3\n/5 in words.\nQUESTION 9\nThe correct answer is a function.")
    assert got == [("7", None, "14", ["spr_text_answer", "verify_math_typography"]), ("8", None, "3", ["spr_text_answer", "verify_math_typography"]), ("9", "A", None, [])]
    got, _ = parsed(spark, "RW\nQUESTION 7\nThe correct answer is 3.5 here.")
    assert got == [("7", None, "3", ["spr_text_answer"])]
    long, rows = parsed(spark, "QUESTION 5\nChoice A is the best answer. " + "word " * 400)
    assert len(rows[0].rationale) == 800


def test_blocks(spark):
    numbers = [1, 2, 3, 45, 4, 5, 1, 2, 9, 3, 2, 2]
    df = spark.createDataFrame([(0, i, n) for i, n in enumerate(numbers)], "k int, pos int, num int")
    got = [r.block for r in answers.assign_blocks(df, ("k",)).orderBy("pos").collect()]
    want, block = [0], 0
    for before, now in zip(numbers, numbers[1:]):
        block += now <= before and now <= 5
        want.append(block)
    assert got == want


def test_runs_and_first_entries(spark):
    rows = [(1, 1, 1, "RW1", "1"), (1, 1, 2, "RW1", "2"), (1, 2, 1, "RW1", "2"), (1, 2, 2, "RW1", "3"), (1, 4, 1, None, "1"), (1, 5, 1, None, "1"), (1, 6, 1, "RW1", "1")]
    df = spark.createDataFrame(rows, "pair int, page_num int, entry_seq int, block_label string, number_label string")
    blocks = answers.answer_blocks(df, ("pair",))
    assert [r.block_index for r in blocks.orderBy("page_num", "entry_seq").collect()] == [0, 0, 0, 0, 1, 1, 2]
    firsts = answers.first_entries(blocks, ("pair",)).orderBy("canon_pos").collect()
    assert [(r.canon_pos, r.page_num, r.number_label) for r in firsts] == [(0, 1, "1"), (1, 1, "2"), (2, 2, "3"), (3, 4, "1"), (4, 6, "1")]


def run(spark, cases):
    items = spark.createDataFrame([(p, i, f"{p}:{i}", x) for p, (labels, _) in enumerate(cases) for i, x in enumerate(labels)], "pair int, item_pos int, item_id string, number_label string")
    canon = spark.createDataFrame([(p, i, x, "A") for p, (_, c) in enumerate(cases) for i, x in enumerate(c)], "pair int, canon_pos int, number_label string, correct_choice string")
    found = {p: {} for p in range(len(cases))}
    for r in align.align(items, canon, ("pair",)).collect():
        found[r.pair][int(r.item_id.split(":")[1])] = r.canon_pos
    return found, items, canon


FIXED = [
    (["1", "2", "3", "1", "2", "3"], ["1", "2", "3", "1", "2", "3"]),
    (["1", "3", "4"], ["1", "2", "3"]),
    (["IV", "1", "2"], ["1", "2"]),
    (["1", "2", "45", "3"], ["1", "2", "3", *map(str, range(4, 60))]),
    (["2", "1", "2", "3", "4"], [str(i) for i in range(1, 28)] * 2),
    ([str(i) for i in (1, 2, 3, 9, 10, 11)], [str(i) for i in range(1, 28)]),
    (["1", "2"], []),
    (["07", "8"], ["7", "8"]),
]


def test_fixed_alignments(spark):
    found, items, canon = run(spark, FIXED)
    for p, (labels, c) in enumerate(FIXED):
        numeric = [i for i, x in enumerate(labels) if x.isdigit()]
        assert [found[p][i] for i in numeric] == model.align([labels[i] for i in numeric], c)
        assert set(found[p]) == set(numeric)
    # entries of numbers that came before, and two pages of each pair
    entries = canon.unionByName(canon.where("pair = 1").withColumn("canon_pos", F.lit(None).cast("int")))
    pages = spark.createDataFrame([(p,) for p in range(len(FIXED)) for _ in range(2)], "pair int")
    offered = items.withColumn("choices", F.when(F.col("item_id") == "1:0", F.array(F.lit("B) x"))).otherwise(F.array(F.lit("A) x"))))
    rep = {r.pair: r for r in align.report(align.fold(offered, entries, ("pair",)), pages, ("pair",)).collect()}
    assert (rep[1].matched, rep[1].unmatched_questions, rep[1].orphan_answers, rep[1].match_rate_pct) == (2, 1, 1, 67)
    assert (rep[1].answer_pages, rep[1].answer_entries, rep[1].inconsistent, rep[0].inconsistent) == (2, 6, 1, 0)
    assert rep[2].question_items == 3 and rep[6].matched == 0 and rep[6].orphan_answers == 0
    every = [r for p, r in rep.items() if p is not None]
    for name in ("question_items", "answer_pages", "answer_entries", "matched", "unmatched_questions", "orphan_answers", "inconsistent"):
        assert rep[None][name] == sum(r[name] for r in every)
    nothing = align.fold(offered.where("false"), entries.where("false"), ("pair",))
    assert align.report(nothing, pages.where("false"), ("pair",)).collect()[0].matched == 0


def test_random_alignments_follow_the_model(spark):
    rng = random.Random(4)
    cases = []
    for _ in range(250):
        canon = [str(i) for _ in range(rng.randint(0, 3)) for i in range(1, rng.randint(2, 30))]
        labels = [x for x in canon if rng.random() > 0.2]
        for _ in range(rng.randint(0, 6)):
            labels.insert(rng.randint(0, len(labels)), str(rng.randint(1, 60)))
        cases.append((labels or ["1"], canon))
    found, _, _ = run(spark, cases)
    for p, (labels, canon) in enumerate(cases):
        got = [found[p][i] for i in range(len(labels))]
        assert got == model.align(labels, canon)
        hits = [h for h in got if h is not None]
        assert hits == sorted(set(hits))


def test_pairs_and_consistency(spark):
    docs = [("s", "sat-practice-test-4-digital"), ("s", "sat-practice-test-4-answers-digital"), ("s", "sat-practice-test-5-digital"), ("t", "sat-practice-test-5-answers-digital"), ("s", "x")]
    got = align.doc_pairs(spark.createDataFrame(docs, "source_id string, doc string")).collect()
    assert [tuple(r) for r in got] == [("s", docs[0][1], docs[1][1])]
    rows = spark.createDataFrame([("A", ["A) x", "B) y"]), ("C", ["A) x", "B) y"]), ("C", []), (None, ["A) x"])], "c string, o array<string>")
    assert [r[0] for r in rows.select(align.consistent(F.col("c"), F.col("o"))).collect()] == [True, False, True, True]
