"""Token files: the grammar, random access, and the query against the tokenizer itself."""

import zlib

import numpy as np
import pytest

from leafmill.llm import packing, token_files

SF = "/root/testdata/sf0.001"


def brute(rows, tokenizer):
    """(doc_id, start, n_tokens, crc) in ascending order of id, nulls first."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(packing.vocabulary())


@pytest.mark.parametrize("seed", range(6))
def test_grammar_keeps_every_id(seed):
    rng = np.random.default_rng(seed)
    docs = [rng.choice(50, rng.integers(1, 400), p=np.arange(50, 0, -1) / 1275) for _ in range(40)] + [np.tile(rng.integers(0, 50, 7), 60)] * 5 + [np.zeros(1000, int)]
    many = np.array([len(d) for d in docs])
    ids, first = np.concatenate(docs), np.cumsum(many) - many
    image = token_files.compress(ids, first, 50)
    shard = token_files.Shard(image)
    assert (shard.ids() == ids).all()
    assert len(shard.symbols) < len(ids) * 0.7
    ends = {int(x) for x in shard.begin}
    assert len(ends) == len(docs)
    for k, doc in enumerate(docs):  # no rule crosses the end of a document
        assert (shard.document(k) == doc).all()
        assert shard.lengths[shard.symbols[shard.begin[k] :]].sum() == len(ids) - first[k]
    for a, b in rng.integers(0, len(ids) + 1, (60, 2)):
        a, b = sorted((int(a), int(b)))
        assert (shard.slice(a, b) == ids[a:b]).all()


def test_rules_are_frequent_pairs_of_ids_or_earlier_rules():
    rng = np.random.default_rng(9)
    ids = np.tile(rng.integers(0, 30, 200), 20)
    shard = token_files.Shard(token_files.compress(ids, np.array([0]), 30))
    assert len(shard.left) and (np.diff(shard.rounds) > 0).all()
    for a, b in zip(np.append(0, shard.rounds[:-1]), shard.rounds, strict=True):
        assert (shard.left[a:b] < 30 + a).all() and (shard.right[a:b] < 30 + a).all()
        assert (shard.length[a:b] == shard.lengths[shard.left[a:b]] + shard.lengths[shard.right[a:b]]).all()
    uses = np.bincount(np.concatenate([shard.symbols, shard.left, shard.right]), minlength=len(shard.lengths))
    assert uses[30:].min() >= 1
    assert len(set(zip(shard.left.tolist(), shard.right.tolist(), strict=True))) == len(shard.left)


@pytest.mark.parametrize("ids", [[1], [1, 1], [5, 1, 5, 1, 5, 1, 5, 1, 5, 1]])
def test_small_shards(ids):
    first = np.arange(0, len(ids), 2)
    shard = token_files.Shard(token_files.compress(np.array(ids, np.int64), first, 9))
    assert shard.ids().tolist() == ids
    assert [shard.document(k).tolist() for k in range(len(first))] == [ids[a : a + 2] for a in first]


def test_unknown_version_is_refused():
    with pytest.raises(ValueError):
        token_files.Shard(np.array([7, 0, 0, 0, 0, 0], "<u4").tobytes())


def test_edge_cases_and_clashing_names(spark, tokenizer, tmp_path):
    rows = [(5, "b b b b"), (None, "null id"), (3, None), (3, ""), (2, "same"), (2, "same"), (9, "word " * 30000), (7, "ünïcode ½ 漢字 <|endoftext|>"), (None, None), (1, " ")]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, part int, image string").repartition(3)
    got = sorted(token_files.round_trip(docs).collect(), key=lambda r: r["start"])
    want = brute(rows, tokenizer)
    assert [(r["doc_id"], r["n_tokens"]) for r in got if r["doc_id"] is not None] == [(a, c) for a, _, c, _ in want if a is not None]
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(a), c, d) for a, _, c, d in want)
    ends = np.cumsum([r["n_tokens"] for r in got])
    assert [r["start"] for r in got] == [0, *ends[:-1].tolist()]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.round_trip(docs, keep_ids=True).collect() == []


def test_shards_ranges_and_a_hot_id(spark, tokenizer, tmp_path):
    """Small shards over several tasks: starts are gapless, ranges decode alone, rows of one id spread."""
    rows = [(4 if i % 3 else i, f"text {i} " + "again and again " * (i % 17)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = str(tmp_path / "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_ids(docs, path, shard_tokens=700)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = token_files.shards(spark, path)
    parts = [r["n_tokens"] for r in found.groupBy("part").sum("n_tokens").toDF("part", "n_tokens").collect()]
    assert len(parts) == 4 and max(parts) < 2 * sum(parts) / 4
    got = sorted(token_files.read_ids(spark, path).collect(), key=lambda r: r["start"])
    stream = np.concatenate([r["ids"] for r in got])
    assert [r["doc_id"] for r in got] == sorted(r[0] for r in rows)
    want = brute(rows, tokenizer)
    assert len(stream) == sum(w[2] for w in want)
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((a, c, d) for a, _, c, d in want)
    for a, b in ((0, 10), (650, 2200), (len(stream) - 5, len(stream)), (100, 100)):
        pieces = sorted(token_files.read_range(spark, path, a, b).collect())
        assert [x for p in pieces for x in p["ids"]] == stream[a:b].tolist()
        if pieces:
            assert pieces[0]["start"] == a


def test_query(spark, tokenizer):
    import os

    from leafmill.llm import entry

    if not os.path.isdir(SF):
        pytest.skip("no tables")
    got = sorted(entry.queries()["op13_token_files"](spark, SF).collect(), key=lambda r: r["start"])
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert [tuple(r) for r in got] == brute(rows, tokenizer)
