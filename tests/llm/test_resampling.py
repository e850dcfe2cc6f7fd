"""Importance resampling against a plain version of its contract and its SQL."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import pytest

from leafmill.llm import entry, resampling

SF = "/root/testdata/sf0.001"
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text, ngrams):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, ngrams + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, ngrams=1, buckets=10_000, percent=10, least=20):
    """Rows (doc_id, n_words, n_features, weight, score, rank) in the order of `docs`."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    split = [grams(t, ngrams) for _, t in docs]
    s, t = Counter(bucket(f) for _, fs in split for f in fs), Counter(bucket(f) for text in target for f in grams(text, ngrams)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    rows = []
    for (doc_id, _), (n_words, fs) in zip(docs, split, strict=True):
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, n_words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = k
    return [tuple(r) for r in rows]


def text(i):
    return " ".join(f"{w}{(i * k) % 13}" for k, w in enumerate(["Alpha", "béta", "G-h", "x_y", "漢字", "ten"] * (1 + i % 9)))


@pytest.mark.parametrize("ngrams", [1, 2, 3])
def test_against_brute_force(spark, ngrams, monkeypatch):
    docs = [(i, text(i)) for i in range(120)] + [(500, None), (501, ""), (502, "... !!"), (503, "Ünï À B"), (504, "long " * 50_000), (505, "one"), (7, text(3)), (7, text(3))]
    target = [text(2), "alpha1 alpha1", None, ""]
    monkeypatch.setattr(resampling, "GROUP_BYTES", 3000)
    df = spark.createDataFrame([(*d, 1, 2.0) for d in docs], "doc_id long, text string, weight int, score double").repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, goal, ngrams=ngrams, buckets=97, percent=30).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(docs, target, ngrams, 97, 30), key=repr)


def test_null_ids_ties_and_a_hot_id(spark):
    docs = [(None, text(i)) for i in range(40)] + [(3, text(8))] * 60
    got = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(text(8),)], "text string"), percent=50).collect()
    want = brute(docs, [text(8)], percent=50)
    assert Counter(r[:5] for r in map(tuple, got)) == Counter(r[:5] for r in want)
    assert sorted(r["rank"] for r in got if r["rank"]) == sorted(r[5] for r in want if r[5])
    drawn, left = ([r["score"] for r in got if bool(r["rank"]) == b and r["n_words"] >= 20] for b in (True, False))
    assert min(drawn) >= max(left)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, text(5))], "doc_id long, text string")
    assert resampling.resample(empty, some.select("text")).collect() == []
    got = resampling.resample(some, empty.select("text")).collect()
    assert [tuple(r) for r in got] == brute([(1, text(5))], [])


def test_dictionaries_that_start_again_change_nothing(monkeypatch):
    import pyarrow as pa

    texts = [pa.array([text(i) for i in range(a, a + 5)] + [None]) for a in range(0, 50, 5)]

    def buckets():
        hasher = resampling.Hasher(2, 50)
        return [[(a.tolist(), b.tolist()) for a, b in hasher.features(t)] for t in texts]

    whole = buckets()
    monkeypatch.setattr(resampling, "DICTIONARY", 10)
    assert buckets() == whole


def test_each_distinct_ngram_is_hashed_once(monkeypatch):
    import pyarrow as pa

    calls = Counter()
    monkeypatch.setattr(resampling.zlib, "crc32", lambda b, real=zlib.crc32: (calls.update([b]), real(b))[1])
    hasher = resampling.Hasher(2, 50)
    for _ in range(3):
        list(hasher.features(pa.array([text(1), text(2), text(1)])))
    assert set(calls.values()) == {1}
    assert {c.decode() for c in calls} == {f for t in (text(1), text(2)) for f in grams(t, 2)[1]}


def test_query_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = con.execute(entry.oracle_sql()["op12_importance_resampling"]).fetchall()
    got = [tuple(r) for r in entry.queries()["op12_importance_resampling"](spark, SF).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(got, key=repr) == sorted(((r[0], *r[2:]) for r in brute(docs, target)), key=repr)
