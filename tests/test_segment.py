"""Segmentation of pages into items."""

import random

import pytest
from pyspark.sql import functions as F

from leafmill.functions import text as t
from leafmill.operators import segment

from . import model

KEYS = "source_id string, doc string, page_num int, page_text string"


def items(spark, *pages):
    df = spark.createDataFrame([("s", "d", i, p) for i, p in enumerate(pages)], KEYS)
    found = {i: [] for i in range(len(pages))}
    for r in segment.segment_items(df).orderBy("page_num", "item_seq").collect():
        found[r.page_num].append((r.item_seq, r.number_label, r.stem, r.choices, r.kind, r.start_line, r.flags))
    return [found[i] for i in range(len(pages))]


CASES = [
    "7. What is the sum of the first\nfour primes, in base ten?\n8) How many sides has a hexagon?",
    "1926. A year opens no item here.\nMore text of a page.",
    "12\n",
    "5\nWhich choice completes the text with the most\nlogical word?\nA) first\nB) second one\nthat wraps\nC) third\nD) fourth",
    "Module\n2\n.........\nThis sentence follows a module label here.",
    "3. Which of these is a prime number?\nA) 4\nB) 5\n...............\n4. Next question of the page, please?",
    "9, The scanner read a comma after the number here.",
    "IV. A roman item with a stem that is long enough.\nV. short",
    "2. Choose one of the four:\n(A) red\nB. green\nC] blue\nD) grey",
    "6. Write the product of six and seven.\nAns.______",
    "6. Ans. ____",
    "1. Consider the function f.\n(a) Find f(0) and f(1) as well.\n(b) Draw it.",
    "4. The text goes on and stops in the middle of a",
    "4. Too short",
    "10. Pick one: A) yes it is B) no it is not?",
    "7. A) foo bar\nB) baz",
    "61\nA lone number over sixty opens no item at all.",
    "15\n3. An item follows a lone number here, long enough.",
    "",
    "no items at all\non this page",
    "1. Whole text with   odd spaces and a line separator inside.",
    "3. One choice only in this item:\nA) alone",
]


def test_cases_follow_the_model(spark):
    for page, got in zip(CASES, items(spark, *CASES), strict=True):
        assert got == model.segment(page), page


def test_named_behaviours(spark):
    got = items(spark, *CASES)
    assert [x[1] for x in got[0]] == ["7", "8"] and got[0][0][2].endswith("in base ten?")
    assert got[1] == [] and got[2] == []
    assert got[3][0][3][1] == "B) second one that wraps" and got[3][0][4] == "multiple_choice"
    assert got[4] == []
    assert got[5][0][3] == ["A) 4", "B) 5"]
    assert got[7][0][6][0] == "roman_numbered" and len(got[7]) == 1
    assert got[9][0][4] == "free_response" and "Ans" not in got[9][0][2]
    assert got[10][0][2] == "" and got[10][0][4] == "free_response"
    assert "has_subparts" in got[11][0][6] and "truncated_at_page_end" in got[12][0][6]
    assert "short_stem" in got[13][0][6] and "inline_choices" in got[14][0][6]
    assert got[15][0][3][0] == "A) foo bar"
    assert got[21][0][6] == ["lonely_choice"]


def test_random_pages_follow_the_model(spark):
    rng = random.Random(8)
    parts = ["{n}. ", "{n}", "{n})", "A) ", "B) ", "(C) ", "D] ", "Ans.___", "IV. ", "II) ", "......", "module", "(a) ", "(b)", "", "   ", "A. x B. y", "answer"]
    words = "the sum of two odd numbers is even when both are prime and A) or B) not".split()

    def page():
        out = []
        for _ in range(rng.randint(0, 14)):
            text = " ".join(rng.choices(words, k=rng.randint(0, 6)))
            out.append(" " * rng.choice((0, 0, 0, 2, 9)) + rng.choice(parts).format(n=rng.randint(1, 130)) + text + rng.choice(("", ".", "?", " ")))
        return rng.choice(("\n", "\n", "\r\n")).join(out)

    pages = [page() for _ in range(1200)]
    for p, got in zip(pages, items(spark, *pages), strict=True):
        assert got == model.segment(p), p


@pytest.mark.parametrize(
    ("flags", "source", "conf", "want"),
    [([], "text_layer", None, "ok"), (["roman_numbered", "has_subparts"], "text_layer", None, "ok"), (["short_stem"], "text_layer", None, "needs_review"), ([], "ocr", 91.0, "ok"), ([], "ocr", 69.9, "needs_review"), ([], "ocr", None, "needs_review"), (["inline_choices"], "ocr", 90.0, "needs_review")],
)
def test_status(spark, flags, source, conf, want):
    row = spark.createDataFrame([(flags, source, conf)], "f array<string>, s string, c double")
    assert row.select(segment.item_status(F.col("f"), F.col("s"), F.col("c"))).first()[0] == want


def test_item_records(spark):
    rows = [("s", "d", 12345, "1. A question that is long enough?\n2. Another that is long enough?", "text", None, None, "T"), ("s", "d", 7, "1. A question that is long enough?", "image", "good", 88.0, "T"), ("s", "d", 8, "1. A question", "image", "review", 10.0, "T"), ("s", "d", 9, "1. x", "image", None, None, "T")]
    plan = spark.createDataFrame(rows, KEYS + ", route string, quality_flag string, ocr_mean_conf double, usage_tag string")
    chosen = segment.choose_text(plan)
    assert {r.page_num: r.skip_reason for r in chosen.collect()} == {12345: None, 7: None, 8: "ocr_quality_review", 9: "no_ocr_result"}
    got = {r.item_id: (r.status, r.ocr_mean_conf) for r in segment.question_items(chosen).collect()}
    assert got == {"s:d:p12345:1": ("ok", None), "s:d:p12345:2": ("ok", None), "s:d:p0007:1": ("ok", 88.0)}


def test_no_exchange(spark):
    pages = spark.createDataFrame([("s", "d", 1, "1. x")], KEYS)
    plan = segment.segment_items(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_strip_is_that_of_python_and_no_pattern(spark):
    text = [f"{chr(c)}a{chr(c)}b{chr(c)}" for c in range(0x10000) if not 0xD800 <= c < 0xE000] + [" \u2003\x1f\t x \u3000\n", " \r\n", "", "\U0001f600 "]
    df = spark.createDataFrame([(x,) for x in text], "x string")
    got = df.select("x", t.strip("x").alias("y"))
    assert all(r.y == r.x.strip() for r in got.collect())
    assert "regexp_replace" not in got._jdf.queryExecution().toString()  # a pattern over every line of every page took a third of the segmentation
