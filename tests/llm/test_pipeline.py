"""The corpus pipeline over a small table with planted cases."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leafmill.llm import entry

from .test_text import SAMPLES, labelled


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(1)
    rows = [(i, t, "en", "s", len(t)) for i, t, _ in labelled(400)]
    rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0), (1002, "42 !!", "en", "s", 5), (1003, "write to jo@mail.example.com or 10.1.2.3 " + SAMPLES["en"], "en", "s", 1)]
    long = " ".join(rng.choices(SAMPLES["en"].split(), k=200)).split()
    rows += [(1100, " ".join(long), "en", "s", 1), (1101, " ".join([*long[:-1], "other"]), "en", "s", 1), (1102, " ".join(long), "en", "t", 1)]
    spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in labelled(400)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_take_effect(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], folder).write.parquet(f"{tmp_path}/{k}-{name}")
        seen.append(spark.read.parquet(f"{tmp_path}/{k}-{name}"))
    assert all(tuple(d.columns) == corpus_pipeline.COLUMNS for d in seen[1:-1])
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    toxic = {i for i, _, y in labelled(400) if y}
    assert len(toxic & ids[1]) < 0.05 * len(toxic) and len(ids[1]) >= len(ids[0] - toxic) - 4
    assert ids[1] - ids[2] == {1000, 1001, 1002}
    assert {1100, 1101, 1102} & ids[3] == {1100} and 1003 in ids[3]
    red = {r.doc_id: r for r in seen[4].collect()}
    assert red[1003].text.startswith("write to <EMAIL> or <IP> ") and red[1003].n_chars == len(red[1003].text)
    assert ids[4] == ids[3] == ids[5]
    run = corpus_pipeline.run(spark, folder)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(cols).collect())) == sorted(map(tuple, seen[5].select(cols).collect()))
    assert all(r.length > 0 for r in run.collect())


def test_one_row_of_a_repeated_id(spark, folder):
    long = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(long)), (1, " ".join(long)), (1, "another text"), (2, " ".join(long[:-1])), (2, ""), (3, ""), (3, "some words"), (None, "x y"), (None, "x y")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, folder).collect()
    assert sorted([(r.doc_id or 0, r.text) for r in got]) == [(0, "x y"), (0, "x y"), (1, " ".join(long)), (3, "some words")]


def test_ties_and_very_long_texts_of_a_repeated_id(spark, folder):
    """Of texts of equal length the first stays; a very long text is compared whole."""
    huge = " ".join(f"w{i}" for i in range(120_000))
    rows = [(4, "seven words that tie with the others a"), (4, "seven words that tie with the others b"), (6, huge), (7, huge[: -len(" w119999")]), (8, " ".join(huge.split()[::-1]))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, folder).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([rows[0], rows[2], rows[4]])


def test_texts_in_another_language_than_filed_go(spark, folder):
    rng = random.Random(3)
    text = lambda lang: " ".join(rng.choices(SAMPLES[lang].split(), k=80))
    rows = [(i, text(lang), lang) for i in range(240) for lang in (("en", "de", "fr")[i % 3],)]
    odd = [(1000, text("de"), "en"), (1001, text("fr"), None), (1002, text("en"), "xx"), (1003, text("en") + " " + text("de")[:90], "en"), (None, text("fr"), "de"), (None, text("fr"), "fr"), (1000, text("en"), "en")]
    docs = spark.createDataFrame([(*r, "s", 1, "x", 0.5) for r in rows + odd], "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, score double")
    kept = corpus_pipeline.drop_unreadable(spark, docs, folder).collect()
    assert {r.doc_id for r in kept if r.doc_id is not None and r.doc_id < 240} == set(range(240))
    assert sorted((r.doc_id or 0, r.lang or "") for r in kept if r.doc_id is None or r.doc_id >= 240) == [(0, "fr"), (1000, "en"), (1001, ""), (1002, "xx"), (1003, "en")]
    none = corpus_pipeline.drop_unreadable(spark, docs.withColumn("lang", F.lit(None).cast("string")).unionByName(docs.limit(1).withColumn("text", F.lit("12 !"))).where("lang is null or text = '12 !'").withColumn("lang", F.lit(None).cast("string")), folder)
    assert none.count() == len(rows) + len(odd)


def test_empty_input(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 0


def test_queries_return_their_columns(spark, folder):
    known = entry.queries()
    assert len(known) == 13 and all(k.startswith("op") for k in known)
    got = known["op6_toxicity"](spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert {r.doc_id: r.held_out for r in got.where(F.col("doc_id") < 50).collect()} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}
    assert known["op8_language_id"](spark, folder).columns == ["doc_id", "held_out", "lang_pred", "score"]
