"""Page measurement, classes and routes."""

import pytest
from pyspark.sql import functions as F

from leafmill.functions import text as t
from leafmill.operators import classify

FIELDS = {"page_num": 10, "doc_page_count": 60, "text_chars": 1200, "word_count": 220, "alnum_ratio": 0.80, "ink_ratio": 0.05, "head_text": "Solve 3x + 4 = 19 for x."}


def decide(spark, **over):
    row = {**FIELDS, **over}
    schema = "page_num int, doc_page_count int, text_chars long, word_count long, alnum_ratio double, ink_ratio double, head_text string"
    return classify.classify(spark.createDataFrame([tuple(row[k] for k in FIELDS)], schema)).first()


@pytest.mark.parametrize(
    ("over", "kind", "route"),
    [
        ({}, "content", "text"),
        ({"text_chars": 0, "word_count": 0, "alnum_ratio": 0.0, "ink_ratio": 0.001, "head_text": ""}, "blank", "skip"),
        ({"text_chars": 40, "word_count": 6, "ink_ratio": 0.005, "head_text": "This page holds no test material"}, "blank", "skip"),
        ({"head_text": "PRACTICE TEST 4\nAnswer  Key\n1. B"}, "answer_key", "text"),
        ({"head_text": "Answer explanation for section 2"}, "answer_key", "text"),
        ({"head_text": "Scoring your test"}, "answer_key", "text"),
        ({"head_text": "Form K\n  ANSWERS \n1 A"}, "answer_key", "text"),
        ({"head_text": "x" * 130 + "\nanswers\n"}, "content", "text"),
        ({"head_text": "Correct answers to eight questions make a full paper"}, "content", "text"),
        ({"text_chars": 500, "word_count": 80, "head_text": "Table of  Contents\nPart 1"}, "index", "skip"),
        ({"word_count": 451, "head_text": "contents\n1"}, "content", "text"),
        ({"word_count": 450, "head_text": " Index \n1"}, "index", "skip"),
        ({"page_num": 1, "text_chars": 120, "word_count": 15, "head_text": "The Test"}, "cover", "skip"),
        ({"page_num": 1, "text_chars": 2000}, "content", "text"),
        ({"page_num": 3, "text_chars": 340}, "content", "text"),
        ({"text_chars": 800, "alnum_ratio": 0.30}, "content", "image"),
        ({"text_chars": 50, "word_count": 7, "ink_ratio": 0.08}, "content", "image"),
        ({"text_chars": 200, "alnum_ratio": 0.55}, "content", "text"),
        ({"text_chars": 199}, "content", "image"),
        ({"text_chars": 149, "ink_ratio": 0.009}, "blank", "skip"),
    ],
)
def test_decisions(spark, over, kind, route):
    got = decide(spark, **over)
    assert (got["classification"], got["route"]) == (kind, route)
    assert got["reason"]


def test_reasons_name_the_rule(spark):
    assert decide(spark, head_text="answer key").reason == r"header matches answer pattern /answer\s+key/; text layer usable (1200 chars, alnum 0.80)"
    assert "text layer too thin (60 chars < 200) -> image/OCR path" in decide(spark, text_chars=60).reason
    assert "page 1 of 60" in decide(spark, page_num=1, text_chars=100).reason


def test_orientation(spark):
    got = spark.range(1).select(classify.orientation(F.lit(792.0), F.lit(612.0)).alias("a"), classify.orientation(F.lit(612.0), F.lit(792.0)).alias("b"), classify.orientation(F.lit(1.0), F.lit(1.0)).alias("c")).first()
    assert tuple(got) == ("landscape", "portrait", "portrait")


def test_reclassify_changes_nothing_under_the_same_rules(spark):
    rows = spark.createDataFrame([("s", "d", i, 100 * i, 10 * i, 0.8, 0.02, "text " * i) for i in range(1, 9)], "source_id string, doc string, page_num int, text_chars long, word_count long, alnum_ratio double, ink_ratio double, head_text string")
    stored = classify.classify(rows.withColumn("doc_page_count", F.lit(8)))
    assert classify.reclassify(stored).count() == 0
    moved = classify.reclassify(stored.withColumn("route", F.lit("other")))
    assert moved.count() == 8
    assert all(r.reason.startswith("[reclassified] ") for r in moved.collect())


SAMPLES = ["", "  ", "a b", " é x \x1c", "²½Ⅳé中 - _", "one\r\ntwo\rthree\x0bfour\x85five six", "tab\tsep  two", "İ ß ﬁ", "a\n"]


def test_text_functions_follow_python(spark):
    rows = spark.createDataFrame([(s,) for s in SAMPLES], "s string").select("s", t.strip("s").alias("strip"), t.word_count("s").alias("n"), t.collapse("s").alias("c"), t.alnum_ratio("s").alias("r"), t.lines("s").alias("lines")).collect()
    for r in rows:
        solid = "".join(r.s.split())
        assert r.strip == r.s.strip()
        assert r.n == len(r.s.split())
        assert r.c == " ".join(r.s.split())
        assert r.r == pytest.approx(sum(c.isalnum() for c in solid) / len(solid) if solid else 0.0)
        assert [x for x in r.lines if x] == [x for x in r.s.splitlines() if x]


@pytest.mark.parametrize("places", [0, 1, 2, 3, 4])
def test_fixed_point_follows_the_binary_value(spark, places):
    """Ties of the binary value go to the even digit; what only looks like a tie in decimals does not."""
    import random
    import struct

    from leafmill.functions import text as t

    rng = random.Random(places)
    values = [0.125, 0.375, 0.145, 0.5, 1.5, 2.5, 0.005, 0.015, 0.0625, 0.9999, 0.99995, 9.995, 1e-5, 5e-324, 2.0**-40, 0.0, -0.0, -0.125, -1e-9, 2.0**37 + 0.5, 123456789.015625, 1e17, 1 / 3, float("nan"), float("inf"), float("-inf")]
    values += [k / 16 for k in range(64)] + [k / 10000 for k in range(0, 10001, 7)] + [rng.random() * 10 ** rng.randint(-6, 6) for _ in range(300)]
    values += [struct.unpack("d", struct.pack("Q", rng.getrandbits(52) | (rng.randint(970, 1055) << 52)))[0] for _ in range(300)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(t.fixed("x", places)).collect()]
    assert [(v, g) for v, g in zip(values, got, strict=True) if g != f"{v:.{places}f}"] == []
