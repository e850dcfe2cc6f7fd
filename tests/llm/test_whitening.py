"""Whitening: error-free sums against fractions, components against another solver, the query against brute force."""

import math
import os
from fractions import Fraction

import numpy as np
import pytest

from leafmill.llm import entry, whitening

SF = "/root/testdata/sf0.001"


def exact_covariance(x):
    n, rows = len(x), [[Fraction(float(v)) for v in r] for r in x]
    mean = [sum(c) / n for c in zip(*rows, strict=True)]
    return [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in rows) / n for j in range(len(mean))] for i in range(len(mean))], mean


def test_sums_of_products_keep_what_doubles_lose():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3, 701)) * 10.0 ** rng.integers(-12, 12, (3, 701))
    high, low = whitening.outer_sums(x, np.zeros_like(x))
    k = 0
    for i in range(3):
        for j in range(i, 3):
            want = sum(Fraction(float(a)) * Fraction(float(b)) for a, b in zip(x[i], x[j], strict=True))
            scale = sum(abs(Fraction(float(a)) * Fraction(float(b))) for a, b in zip(x[i], x[j], strict=True))
            assert abs(Fraction(high[k]) + Fraction(low[k]) - want) <= scale * Fraction(1, 10**29)
            k += 1


def test_total_of_integers_is_exact():
    rng = np.random.default_rng(2)
    x = rng.integers(-(1 << 52), 1 << 52, 4097).astype(float)
    high, low = whitening.total(x, np.zeros_like(x))
    assert int(high) + int(low) == sum(int(v) for v in x)
    assert whitening.total(np.zeros((2, 0)), np.zeros((2, 0)))[0].tolist() == [0, 0]


def test_covariance_and_components(spark):
    """A shift of 1e8 leaves nothing of the covariance in plain one-pass sums; here it is whole, over several tasks."""
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(600, 5)) @ rng.normal(size=(5, 5)) + 1e8).astype(float)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "k long, v array<double>").repartition(40)
    space = whitening.fit(df, "v", components=5)[5]
    cov, mean = exact_covariance(x)
    assert max(abs(Fraction(float(a)) + Fraction(float(b)) - m) for a, b, m in zip(*space.mean, mean, strict=True)) < Fraction(1, 10**20)
    c = np.array([[float(v) for v in r] for r in cov])
    assert np.allclose(space.components.T @ np.diag(space.values) @ space.components, c, rtol=1e-13, atol=1e-13)
    assert math.isclose(space.trace, float(sum(cov[i][i] for i in range(5))), rel_tol=1e-15)
    for value, vector in zip(space.values, space.components, strict=True):  # the residual in fractions, far below that of doubles alone
        e = [Fraction(float(v)) for v in vector]
        rest = [sum(a * b for a, b in zip(row, e, strict=True)) - Fraction(float(value)) * v for row, v in zip(cov, e, strict=True)]
        assert max(abs(float(r)) for r in rest) < 4e-16 * space.values[0]
    w = np.array([r[0] for r in whitening.whiten(df, "v", {5: space}, "k").select("whitened").collect()])
    assert len(w) == 3000
    assert whitening.identity_error(df, "v", {5: space})[5] < 1e-12


def brute(rows):
    """Rows by vec_id (a list) as the contract says them, by fractions and numpy's solver."""
    fit = [[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in rows]
    n, d = len(fit), len(fit[0])
    s = [sum(c) for c in zip(*fit, strict=True)]
    off = np.array([[n * a - b for a, b in zip(r, s, strict=True)] for r in fit], object)
    cov = np.array([[float(Fraction(int(v), n**3)) for v in r] for r in off.T @ off])
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:8]
    w = (off / n).astype(float) @ vectors[:, order] / np.sqrt(values[order])
    return n, [int((r * r).sum()) for r in off], w, values[order] / np.trace(cov), min(8, d)


def agrees(got, rows):
    n, deviation, w, explained, k = brute(rows)
    assert len(got) == k * n
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    place = {v: i for i, (v, _) in enumerate(rows)}
    for c, found in by.items():
        at = [place[r["vec_id"]] for r in found]
        mine, other = np.array([r["whitened"] for r in found]), w[at, c - 1]
        sign = np.sign(mine @ other)
        assert np.allclose(mine, sign * other, rtol=1e-8, atol=1e-8)
        assert all(r["n"] == n and r["deviation"] == deviation[i] for r, i in zip(found, at, strict=True))
        assert np.allclose([r["explained"] for r in found], explained[c - 1], rtol=1e-12)
        assert {r["identity_error"] for r in found} == {got[0]["identity_error"]}
    assert got[0]["identity_error"] < 1e-10


def test_query(spark):
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").where("embedding is not null").collect()]
    rows = [r for r in rows if all(v is not None and math.isfinite(v) for v in r[1])]
    agrees(entry.queries()["op11_embedding_whitening"](spark, SF).collect(), rows)


def test_edge_cases_and_clashing_names(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=3).tolist()) for i in range(20)] + [(None, [0.5, 0.25, 0.0]), (20, [1.0, 1.0, 1.0]), (21, [1.0, 1.0, 1.0])]
    bad = [(30, None), (31, [1.0, None, 2.0]), (32, [float("nan"), 1.0, 2.0]), (33, [float("inf"), 1.0, 2.0]), (34, []), (35, [7.0])]
    df = spark.createDataFrame([(*r, 0, "x", 1.0) for r in good + bad], "vec_id long, embedding array<float>, n int, component string, d double")
    got = whitening.whitened_embeddings(df).collect()
    agrees([r for r in got if r["d"] == 3], good)
    alone = [r for r in got if r["d"] != 3]  # a vector of another length: a space of its own, without variance
    assert [(r["vec_id"], r["d"], r["n"], r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone] == [(35, 1, 1, 1, 0, None, None, 0.0)]


def test_empty_and_degenerate_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened_embeddings(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened_embeddings(spark.createDataFrame([(1, None)], schema)).collect() == []
    got = whitening.whitened_embeddings(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 6.0])], schema)).collect()
    live = {r["vec_id"]: r for r in got if r["component"] == 1}
    assert sorted(round(r["whitened"], 12) for r in live.values()) == [-1.0, 1.0]
    assert all(r["whitened"] is None and r["explained"] == 0 for r in got if r["component"] == 2)


def test_very_large_entries(spark):
    """Entries beyond the integers' range are held; what 64 bits do not hold is null."""
    got = whitening.whitened_embeddings(spark.createDataFrame([(1, [3e38]), (2, [-3e38]), (3, [0.0])], "vec_id long, embedding array<float>")).collect()
    assert {r["vec_id"]: r["deviation"] for r in got}[1] is None
    assert all(abs(r["whitened"]) < 2 for r in got)


def test_merging_does_not_depend_on_tasks(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 4)))], "k long, v array<double>")
    one, many = (whitening.fit(df.repartition(n), "v")[4] for n in (1, 70))
    assert np.array_equal(one.mean[0], many.mean[0]) and np.allclose(one.values, many.values, rtol=1e-15)
    assert np.allclose(one.components, many.components, rtol=1e-12, atol=1e-14)
