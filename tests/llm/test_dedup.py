"""Near duplicates of texts and vectors, and fingerprints, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from leafmill.llm import common, embedding_dedup, near_dedup, spotsigs

DOCS = "doc_id long, text string, n int, name string, rep long, cluster long, key long, part int"


def docs(spark, rows):
    """Rows (doc_id, text) with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, 5) for r in rows], DOCS)


def words_of(text):
    return text.encode().lower().split() if text else []


def brute_components(rows, words, percent):
    sets = {}
    for i, text in rows:
        w = words_of(text)
        k = min(words, len(w))
        sets.setdefault(i, []).append(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(i for i in sets if i is not None)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}, sets


def corpus(seed, n=90):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, passage = [], " ".join(rng.choices(vocab, k=30))
    for i in range(n):
        kind = rng.random()
        if kind < 0.4 or not rows:
            text = " ".join(rng.choices(vocab, k=rng.randint(1, 80)))
        elif kind < 0.6:
            text = rng.choice(rows)[1]
        elif kind < 0.9:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randint(1, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            text = rng.choice((" ", "\n", " \t ")).join(w)
        else:
            text = passage + " " + " ".join(rng.choices(vocab, k=25))
        rows.append((i * 3 + 1, text.upper() if rng.random() < 0.1 else text))
    rng.shuffle(rows)
    return rows


EDGES = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (1006, "é É"), (1007, "É É"), (1008, "é É"), (1009, "a b c a b c a b"), (None, "one"), (1010, "x " * 30000 + "end"), (1011, "x " * 30000 + "end")]


@pytest.mark.parametrize(("seed", "words"), [(1, 2), (2, 5)])
def test_near_duplicates_follow_brute_force(spark, seed, words):
    rows = corpus(seed) + EDGES
    want, sets = brute_components(rows, words, 80)
    got = near_dedup.near_duplicates(docs(spark, rows), words, 80).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
            continue
        assert r.component_id == want[r.doc_id] and r.kept == (r.component_id == r.doc_id)
        assert r.n_shingles == len(sets[r.doc_id][0])


def test_long_lists_are_split_without_loss(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(70):
        w = list(base)
        w[rng.randrange(60)] = f"z{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"q{rng.randrange(500)}" for _ in range(40))) for i in range(20)]
    want, _ = brute_components(rows, 2, 80)
    monkeypatch.setattr(near_dedup, "LIST_ROWS", 20)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 900)
    got = near_dedup.near_duplicates(docs(spark, rows), 2, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_repeated_rows_and_ids(spark):
    a, b = "the same text of some words here", "another text altogether with other words"
    got = near_dedup.near_duplicates(docs(spark, [(1, a), (1, a), (2, a), (1, b), (3, b)]), 2, 80).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1)]


def test_each_text_of_a_document_is_compared(spark):
    rng = random.Random(8)
    a, b, c = ([f"{k}{rng.randrange(400)}" for _ in range(50)] for k in "abc")
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (4, " ".join(c)), (5, near(c)), (5, " ".join(b[:9])), (6, " ".join(rng.choices(a, k=50)))]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        got = near_dedup.near_duplicates(docs(spark, order), 2, 80).collect()
        assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6)}


def test_no_rows(spark):
    assert near_dedup.near_duplicates(docs(spark, []), 2).count() == 0
    assert spotsigs.fingerprints(docs(spark, [])).count() == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).count() == 0


def test_lower_thresholds_are_refused(spark):
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(docs(spark, []), 2, 70)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 102), (101, 102), (7, 7)] + [(500, i) for i in range(501, 560)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[101] == got[102] == 100 and got[559] == 500
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_value_of_a_whole_key(spark):
    """A hot key, keys of one row, a null key, and no rows."""
    rows = [(1, i) for i in range(1000)] + [(k, k) for k in range(2, 40)] + [(None, 5)]
    df = spark.createDataFrame(rows, "hub long, node long")
    count = lambda d: common.beside(d, "hub", "node", F.count(F.lit(1)), F.sum, "many")
    got = count(df).collect()
    assert sorted((r.hub, r.node, r.many) for r in got) == sorted((h, n, 1000 if h == 1 else 1) for h, n in rows if h is not None)
    assert count(df.where("false")).count() == 0
    star = [(10_000, i) for i in range(3000)] + [(9_000, 10_000)]
    found = common.connected_components(spark.createDataFrame(star, "a long, b long"))
    assert found.count() == 3002 and {r.component for r in found.select("component").distinct().collect()} == {0}


def test_vectors_follow_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        v = rng.normal(size=16)
        if i % 5 == 1:
            v = np.array(rows[-1][1]) if rows[-1][1] else v
        if i % 5 == 2 and rows[-1][1]:
            v = np.array(rows[-1][1]) * 2 + rng.normal(size=16) * rng.choice([0.02, 0.2])
        rows.append((i * 2, [float(np.float32(x)) for x in v], int(i // 30)))
    dense = rng.normal(size=16)
    rows += [(1000 + i, [float(np.float32(x)) for x in dense + rng.normal(size=16) * 0.02], 3) for i in range(80)]
    bad = [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [1.0, None] + [0.0] * 14, 1), (2004, [float("nan")] * 16, 1), (2005, [float("inf")] + [0.0] * 15, 1), (2006, rows[0][1], None), (2007, [1.0, 2.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, 1, "u") for r in rows + bad], "vec_id long, embedding array<float>, label int, rep int, unit string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert len(got) == len(rows) + len(bad)
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    comp = np.array([r[0] for r in rows])
    for _ in range(100):
        comp = np.array([min([comp[i], *comp[near[i]]]) for i in range(len(rows))])
    for i, r in enumerate(rows):
        assert (got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (near[i].sum(), comp[i], comp[i] == r[0])
    for r in bad:
        assert (got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (0, r[0], True)


def test_repeated_vectors_and_no_usable_ones(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [0.0, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    none = df.selectExpr("vec_id", "cast(null as array<float>) embedding", "label")
    assert {r.n_links for r in embedding_dedup.near_duplicates(none).collect()} == {0}


def cone(rng, n, size, cosine):
    """Unit vectors that have about `cosine` with each other."""
    axis = rng.normal(size=size)
    axis /= np.linalg.norm(axis)
    r = rng.normal(size=(n, size))
    r -= (r @ axis)[:, None] * axis
    r /= np.linalg.norm(r, axis=1, keepdims=True)
    return np.sqrt(cosine) * axis + np.sqrt(1 - cosine) * r


@pytest.mark.parametrize("spread", [0, 9000])
def test_links_in_a_dense_cone(spark, spread):
    rng = np.random.default_rng(4)
    x = cone(rng, 3000, 64, 0.95)
    x[2900:] = x[:100] + rng.normal(size=(100, 64)) * 0.0228
    x = np.concatenate([x, rng.normal(size=(spread, 64))])
    rng.shuffle(x)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.98
    np.fill_diagonal(near, False)
    assert near.sum() >= 100 and near.sum(axis=1).max() < 5
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")).collect()}
    assert [got[i].n_links for i in range(len(x))] == near.sum(axis=1).tolist()
    least = list(range(len(x)))
    for _ in range(5):
        least = [min([least[i], *(least[j] for j in np.flatnonzero(near[i]))]) for i in range(len(x))]
    assert [got[i].component_id for i in range(len(x))] == least


def test_vectors_of_two_lengths(spark):
    rows = [(i, [1.0, i // 2, 0.0], 1) for i in range(6)] + [(10 + i, [1.0, i // 2], 1) for i in range(4)] + [(20, [1.0, 0.001], 1), (21, [5.0], 1), (22, [5.0], 2)]
    df = spark.createDataFrame([(i, [float(x) for x in v], k) for i, v, k in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {i: (1, i // 2 * 2) for i in range(6)} | {10: (2, 10), 11: (2, 10), 12: (1, 12), 13: (1, 12), 20: (2, 10), 21: (0, 21), 22: (0, 22)}


def test_passes_grow_with_the_rows():
    few, many = embedding_dedup.passes_for(10_000, 0.98), embedding_dedup.passes_for(10**9, 0.98)
    assert 8 <= few < many < 120


def test_fingerprints_follow_brute_force(spark):
    rows = [(i, t) for i, t in corpus(7, 40)] + [(200, None), (201, ""), (202, "the of and"), (203, "The cat sat on the old mat."), (204, "the cat sat on THE old mat!"), (205, "the word " * 9000)]
    got = {r.doc_id: r for r in spotsigs.fingerprints(docs(spark, rows)).collect()}
    order = sorted(rows, reverse=True)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        t, n = t or "", n or ""
        k = len(t) // 3
        new = t[: len(t) - k] + n[:k]
        r = got[i]
        a, b, c = (spotsigs.signatures(x) for x in (t, new, n))
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == spotsigs.fingerprint(a) and r.edited_fingerprint == spotsigs.fingerprint(b)
        sets = [set(x.tolist()) for x in (a, b, c)]
        assert r.near_edited == pytest.approx(len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0)
        assert r.near_next == pytest.approx(len(sets[0] & sets[2]) / len(sets[0] | sets[2]) if sets[0] | sets[2] else 1.0)
        assert (r.edited_is_near, r.next_is_near) == (r.near_edited >= spotsigs.NEAR, r.near_next >= spotsigs.NEAR)
    assert got[203].fingerprint == got[204].fingerprint != got[202].fingerprint


def test_signatures_follow_their_description():
    """A second version: for each anchor look ahead word by word."""
    rng = random.Random(6)
    vocab = "the of and la und river Stone cloud1 tree's house_2 été straße 7".split() + [f"w{i}" for i in range(40)]
    for _ in range(300):
        text = "".join(rng.choice(vocab) + rng.choice((" ", ", ", "\n", "-")) for _ in range(rng.randint(0, 40)))
        words = [w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split()]
        plain = lambda w: w not in spotsigs.COMMON
        want = set()
        for i, w in enumerate(words):
            if not plain(w) or zlib.crc32(w.encode()) % spotsigs.RARE == 0:
                chain = [x for x in words[i + 1 :] if plain(x)][: spotsigs.CHAIN]
                if len(chain) == spotsigs.CHAIN:
                    want.add(f"{w} {' '.join(chain)}")
        if words:
            want.add("^ " + " ".join(([w for w in words if plain(w)] or words)[: spotsigs.CHAIN]))
        assert spotsigs.signatures(text).tolist() == sorted({xxhash.xxh32_intdigest(x.encode()) for x in want})


def test_pruning_changes_no_likeness_above_the_floor():
    rng = np.random.default_rng(3)
    for _ in range(400):
        pool = np.sort(rng.choice(100_000, rng.integers(2, 3000), replace=False).astype(np.uint32))
        a, b = (np.sort(rng.choice(pool, rng.integers(1, len(pool) + 1), replace=False)) for _ in range(2))
        value = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        for floor in (0.0, 0.02, 0.3, 0.5, 0.9):
            assert spotsigs.likeness(a, b, floor) == pytest.approx(value if value >= floor else 0.0)


def test_fingerprints_of_ties_and_nulls(spark):
    rows = [(None, "the a b c"), (5, None), (5, "x"), (5, "the x y z"), (7, "")]
    got = spotsigs.fingerprints(docs(spark, rows)).collect()
    assert sorted((r.n_chars for r in got)) == [0, 0, 1, 9, 9]
    one = spotsigs.fingerprints(docs(spark, [(1, "the one row there is")])).first()
    assert one.near_next == 1.0


def test_pruned_likeness():
    a, b = np.arange(10, dtype=np.uint32), np.arange(5, 15, dtype=np.uint32)
    assert spotsigs.likeness(a, b) == pytest.approx(5 / 15) and spotsigs.likeness(a, b, 0.5) == 0.0 and spotsigs.likeness(a, a[:2], 0.5) == 0.0
    assert spotsigs.likeness(a[:0], b[:0]) == 1.0 and spotsigs.likeness(a, b[:0]) == 0.0


def test_near_pairs_follow_brute_force(spark):
    rng = random.Random(5)
    vocab = "the of and river stone cloud tree house light wind sand road field star lamp door".split()
    rows = []
    for i in range(60):
        w = rng.choices(vocab, k=60) if i % 3 == 0 else list(rows[-1][1].split())
        for _ in range(i % 3 * 2):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    pairs, members = spotsigs.near_pairs(docs(spark, rows), 0.6)
    sets = {i: set(spotsigs.signatures(t).tolist()) for i, t in rows}
    reps = sorted({r.rep for r in members.collect()})
    want = {(a, b) for k, a in enumerate(reps) for b in reps[k + 1 :] if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want
