"""Packing, personal data, segmentation, toxicity, language, shards, URLs."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import common, language, packing, pii, segmentation, sharding, toxicity, url_filter

from .test_dedup import docs

ODD = [(1, None), (2, ""), (3, " \n "), (4, "Hello, World! it's"), (4, "Hello, World! it's"), (5, "é中İΣς ́x"), (6, "<|endoftext|> a\x1cb"), (7, "word " * 9001), (None, "no id"), (8, "x" * 5000), (9, "0\n1\t2 a@b.c")]


# --- packing ----------------------------------------------------------------


def test_pieces_have_the_tokenizers_ids(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.vocabulary())
    got = packing.pieces(docs(spark, ODD)).collect()
    want = collections.Counter()
    for i, t in ODD:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[(i, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want


def test_random_texts_have_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(packing, "GROUP_CHARS", 300)
    enc = packing.Encoder(packing.vocabulary())
    rng = random.Random(2)
    latin = [chr(c) for c in range(0x180) if rng.random() < 0.9] + list("''''stmdrevelloinaethe  ")
    for _ in range(200):
        texts = ["".join(rng.choice(latin if k % 2 else latin[-24:]) for _ in range(rng.randint(0, 150))) for k in range(20)]
        assert enc.encode(texts) == enc._fresh(texts)
    alphabet = "ab Cé,.!'s<|>\n\t \x1cß1２Σς́İ中—’​\x85"
    for _ in range(60):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(20)]
        assert enc.encode(texts) == enc._fresh(texts)


def laid_out(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    return len(by)


def test_packing_is_gapless_and_tight(spark):
    rng = random.Random(1)
    rows = [(i, p, rng.choice((rng.randint(1, 4096), rng.randint(1, 300), 4096)), i) for i in range(700) for p in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long, ids_crc32 long")
    got = packing.pack(df).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.piece) for r in got} == {(r[0], r[1]) for r in rows}
    total = sum(r[2] for r in rows)
    assert laid_out(got) <= -(-total // 4096) + 3


def test_packing_of_documents(spark):
    got = packing.pack_documents(docs(spark, ODD)).persist()
    assert laid_out(got.collect()) <= 4
    seq = packing.sequences(got).collect()
    assert sum(s.n_tokens for s in seq) == sum(len(s.ids) for s in seq) == got.agg(F.sum("length")).first()[0]
    assert packing.pack_documents(docs(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_fullest_is_the_best_sum(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 60): rng.randint(1, 3) for _ in range(8)}
    top = max(counts)
    sums = {0}
    for s, n in counts.items():
        sums = {x + k * s for x in sums for k in range(n + 1 - (s == top))}
    got = packing.fullest(dict(counts), 100)
    assert all(got[s] <= counts[s] for s in got) and got[top] >= 1
    assert sum(s * n for s, n in got.items()) == top + max(x for x in sums if x <= 100 - top)


# --- personal data ------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": lambda: True, "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda d=d: 16 <= len(d) <= 19 and pii.luhn(d), "phone": lambda d=d: 8 <= len(d) <= 15}[kind]()
            if good:
                out[kind].append(m.span())
    return out


def test_base_spans_follow_the_patterns():
    rng = random.Random(1)
    for _ in range(8000):
        text = "".join(rng.choice("0012345.. -+@@ab()é\n") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text)
    fixed = "call +1 (212) 555-0100 or a.b+c@d-e.co.uk, 4111 1111 1111 1111; 10.0.0.255 256.1.1.1 4111-1111-1111-1112"
    assert pii.listed(pii.base_spans(fixed)) == pii.listed(plain_spans(fixed)) and all(pii.base_spans(fixed).values())


def test_base_spans_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@" * 200_000, "1." * 100_000, "+1" * 100_000, "+1" + " " * 200_000, "1 " * 100_000):
        pii.base_spans(text)


def test_tagger_finds_held_out_spans():
    tagger = pii.trained()
    rng = random.Random(1234)
    lines = [pii._example(rng) for _ in range(150)]
    hit = miss = wrong = 0
    for (text, spans), found in zip(lines, pii.model_spans([t for t, _ in lines], tagger), strict=True):
        want = {(pii.KINDS.index(k), a, b) for k, a, b in spans}
        got = {s for s in found if pii.holds(pii.KINDS[s[0]], text[s[1] : s[2]])}
        hit, miss, wrong = hit + len(want & got), miss + len(want - got), wrong + len(got - want)
    assert hit / (hit + miss) > 0.95 and hit / (hit + wrong) > 0.95


def test_gradients():
    tagger = pii.Tagger(4, 1)
    rng = np.random.default_rng(0)
    x, y = rng.integers(1, 20, (7, 3)), rng.integers(0, pii.TAGS, (7, 3))
    _, g = tagger.gradients(x, y)
    for k, v in tagger.p.items():
        i = (x[2, 1], 3) if k[0] == "w" else tuple(rng.integers(0, d) for d in v.shape)
        old, two = v[i], []
        for e in (1e-5, -1e-5):
            v[i] = old + e
            two.append(tagger.gradients(x, y)[0])
        v[i] = old
        assert (two[0] - two[1]) / 2e-5 == pytest.approx(g[k][i], abs=1e-6)


def test_find_and_redact(spark):
    rows = [*ODD, (20, "Call (212) 555-0187 or mail jo.doe@mail.example.com now. " + "filler " * 3000 + "10.1.2.3 end"), (21, "4111 1111 1111 1111" * 2)]
    got = pii.find(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = collections.defaultdict(set)
    for i, t in rows:
        texts[i].add(t or "")
    for r in got:
        assert any((r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(plain_spans(t)[k]) for k in pii.KINDS) for t in texts[r.doc_id])
        base = next(pii.listed(plain_spans(t)) for t in texts[r.doc_id])
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    last = next(r for r in got if r.doc_id == 20)
    assert "phone:5:19" in last.spans and last.n_phone == 0
    red = {r.doc_id: r for r in pii.redact(docs(spark, rows)).collect()}
    assert red[20].text.startswith("Call <PHONE> or mail <EMAIL> now.") and red[20].text.endswith("<IP> end") and red[1].text is None
    assert pii.find(docs(spark, [])).count() == 0


def test_reconcile_keeps_the_heaviest_set():
    rng = random.Random(0)
    for _ in range(200):
        found = {}
        for _ in range(rng.randint(0, 7)):
            a = rng.randint(0, 12)
            found[(rng.randint(0, 3), a, a + rng.randint(1, 5))] = rng.random()
        spans = list(found)
        best = max((sum(found[s] for s in c) for c in ([spans[i] for i in range(len(spans)) if m >> i & 1] for m in range(1 << len(spans))) if all(x[2] <= y[1] or y[2] <= x[1] for k, x in enumerate(c) for y in c[k + 1 :])), default=0)
        got = pii.reconcile(found)
        assert all(x[2] <= y[1] for x, y in zip(got, got[1:])) and sum(found[s] for s in got) == pytest.approx(best)


# --- segmentations --------------------------------------------------------------


def every_segmentation(pieces, text):
    out = {(): 0.0}
    for w in segmentation.words_of(text):
        lat = pieces.lattice([w])

        def ways(node, lat=lat):
            if node == lat.start[1]:
                return {(): 0.0}
            return {(int(lat.piece[e]), *rest): float(lat.log_prob[e]) + lp for e in range(lat.first[node], lat.first[node + 1]) for rest, lp in ways(int(lat.dst[e])).items()}

        out = {a + b: x + y for a, x in out.items() for b, y in ways(0).items()}
    return {tuple(segmentation.spell(pieces, np.array(k, np.int64)).tolist()): v for k, v in out.items()}


def test_words_are_parted_without_a_python_object_for_each(monkeypatch):
    pieces = segmentation.load(segmentation.model_file())
    texts = ["the at\né", "", None, " a  b ", "x\u2581\u2581y", "one " * 3000]
    want = [segmentation.words_of(t) for t in texts]
    assert [(v.split(" ") if v else []) for v in map(segmentation.view_of, texts)] == want and want[3] == ["\u2581\u2581a", "\u2581\u2581b", "\u2581"]
    monkeypatch.setattr(segmentation, "words_of", None)  # samples are drawn without it
    for text, found in zip(texts, segmentation.sample_texts(pieces, texts, list(range(len(texts))), 2), strict=True):
        assert found and all(segmentation.join(pieces, ids) == (text or "").replace("\u2581", " ") for ids, *_ in found)


def test_samples_are_drawn_without_replacement():
    pieces = segmentation.load(segmentation.model_file())
    every = every_segmentation(pieces, "the at\né")
    p = {k: np.exp(v) for k, v in every.items()}
    assert sum(p.values()) == pytest.approx(1)
    n = 6000
    drawn = segmentation.sample_texts(pieces, ["the at\né"] * n, list(range(n)), 3)
    seen = [collections.Counter(tuple(r[i][0].tolist()) for r in drawn) for i in range(3)]
    for r in drawn:
        assert len({tuple(x[0].tolist()) for x in r}) == 3 and r[0][2] >= r[1][2] >= r[2][2]
        assert all(x[1] == pytest.approx(every[tuple(x[0].tolist())]) and x[3] <= 0 for x in r)
    for k in sorted(p, key=p.get)[-4:]:
        assert seen[0][k] / n == pytest.approx(p[k], abs=0.02)
        assert seen[1][k] / n == pytest.approx(sum(p[j] * p[k] / (1 - p[j]) for j in p if j != k), abs=0.02)


@pytest.mark.parametrize("text", ["the at\né", "a", "é中İ", "to be", "İ"])
def test_all_segmentations_come_once(text):
    pieces = segmentation.load(segmentation.model_file())
    every = every_segmentation(pieces, text)
    for row in segmentation.sample_texts(pieces, [text] * 20, list(range(20)), len(every) + 3):
        assert {tuple(x[0].tolist()): pytest.approx(x[1]) for x in row} == every and len(row) == len(every)
        assert all(a[2] >= b[2] for a, b in zip(row, row[1:]))


def test_a_very_long_word():
    """The draws of a word of 20,000 pieces and of the word after it differ; logarithms stand in where sums underflow."""
    pieces = segmentation.load(segmentation.model_file())
    for text in ("\U00010900" * 20_000 + " the at" * 50, "x" * 20_000 + " the at" * 50):
        first, second = segmentation.sample_texts(pieces, [text], [1], 2)[0]
        assert all(segmentation.join(pieces, x[0]) == text for x in (first, second)) and first[0].tolist() != second[0].tolist()
        assert first[1] < 0 and first[2] >= second[2]
    place = np.arange(60_000)
    draws = [segmentation._uniform(np.full(60_000, k, np.uint64), s, place, p) for k in (1, 2) for s in (0, 1) for p in (1, 2)]
    assert len(np.unique(np.concatenate(draws))) == 8 * 60_000


def test_sampling_rows(spark):
    got = segmentation.sample(docs(spark, ODD), 3).collect()
    assert all(r.round_trip for r in got) and {r.doc_id for r in got} == {i for i, _ in ODD}
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(by[1]) == len(by[2]) == 1 and by[1][0].n_ids == 0 and by[1][0].log_prob == 0
    assert len({tuple(r.ids) for r in by[7]}) == 3
    assert sorted(tuple(r.ids) for r in by[4])[::2] == sorted(tuple(r.ids) for r in by[4])[1::2]
    again = segmentation.sample(docs(spark, ODD).repartition(3), 3, keep_ids=False).collect()
    packed = {(r.doc_id, r["sample"]): np.frombuffer(r.ids, "<u4").tolist() for r in segmentation.sample(docs(spark, ODD), 3, packed=True).collect()}
    assert packed == {(r.doc_id, r["sample"]): r.ids for r in got}
    assert collections.Counter((r.doc_id, r.sample, r.ids_crc32) for r in again) == collections.Counter((r.doc_id, r.sample, r.ids_crc32) for r in got)
    assert segmentation.sample(docs(spark, [])).count() == 0


def test_encode_and_decode(spark):
    rows = [r for r in ODD if r[0]]
    back = segmentation.decode(segmentation.encode(docs(spark, rows))).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((i, t or "") for i, t in rows)


# --- learned labels ---------------------------------------------------------------

NEUTRAL = "river stone cloud tree house light wind sand road field star lamp door bread salt glass horse wheel paper clock".split()


def labelled(n=900):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.25
        w = rng.choices(NEUTRAL, k=rng.randint(8, 60))
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(("Dolt,", "nitwit", "blockheads!")))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = labelled()
    d = docs(spark, [r[:2] for r in rows] + [(5000, None), (5001, ""), (5002, "12 34"), (None, "nitwit"), (5003, "nitwit dolt " * 20000)])
    labels = spark.createDataFrame([(r[0], r[2], 1) for r in rows] + [(5000, None, 1), (None, 1, 1)], "doc_id long, toxic int, score int")
    model = toxicity.train(d, labels)
    got = {r.doc_id: r for r in toxicity.score(d.withColumn("score", F.lit("old")), model).collect()}
    out = [(r[2], got[r[0]].predicted) for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(a == b for a, b in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[5003].predicted == 1 and got[5000].score == got[5001].score == got[5002].score < 0.5
    again = toxicity.train(d.unionByName(d).unionByName(d.where("doc_id = 3")), labels)  # repeated rows teach nothing new
    assert np.array_equal(again.w, model.w) and np.array_equal(again.v, model.v)
    assert toxicity.train(d, labels.where("false")) is None
    assert {r.score for r in toxicity.score(d, None).collect()} == {0.0}
    assert toxicity.score(docs(spark, []), model).count() == 0


def test_toxicity_is_not_fitted_on_the_driver(spark, monkeypatch):
    def fit(*_):
        raise AssertionError("the driver's memory is the smallest")

    monkeypatch.setattr(toxicity.Machine, "fit", fit)
    rows = labelled()[:200]
    model = toxicity.train(docs(spark, [r[:2] for r in rows]), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert model.slot.max() == len(model.w) - 1


def pair_rows(n, rule):
    """Texts of neutral terms and of two more, toxic by a rule on these two."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (n, 2))
    texts = [np.unique(np.concatenate([rng.integers(10, 50, 20), np.flatnonzero(r) + 1])).astype(np.int32) for r in x]
    return texts, np.array([rule(*r) for r in x], float)


@pytest.mark.parametrize("rule", [lambda a, b: a != b, lambda a, b: a and b])
def test_factors_learn_a_pair(rule):
    """Two terms that are toxic only apart, or only together, which no sum of weights can say; as shipped."""
    texts, y = pair_rows(6000, rule)
    model = toxicity.Machine(64).fit(texts, y)
    assert ((model.scores(texts) >= 0.5) == (y == 1)).mean() > 0.99


def test_scores_are_the_sum_over_pairs():
    texts, y = pair_rows(400, lambda a, b: a != b)
    model = toxicity.Machine(64).fit(texts, y)
    for t, got in zip(texts[:50] + [np.empty(0, np.int32), np.array([63], np.int32)], model.scores(texts[:50] + [np.empty(0, np.int32), np.array([63], np.int32)])):
        k = [i for i in model.slot[t].tolist() if i]
        z = model.w0 + sum(float(model.w[i]) for i in k) + sum(float(model.v[i] @ model.v[j]) for n, i in enumerate(k) for j in k[n + 1 :])
        assert got == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


SAMPLES = {"en": "the house of the river and the stone was by that old road with light", "de": "das haus und der fluss mit dem stein war auf der alten straße für licht", "fr": "la maison de la rivière et la pierre était près de cette vieille route avec lumière"}


def test_language_on_held_out_rows(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(SAMPLES[lang].split(), k=rng.randint(6, 300))), lang) for i in range(300) for lang in (rng.choice(list(SAMPLES)),)]
    extra = [(900, None, "en"), (901, "", "en"), (902, "12 !?", "de"), (903, SAMPLES["fr"].upper(), None), (None, SAMPLES["de"], "de"), (904, SAMPLES["en"] * 400, None)]
    d = spark.createDataFrame([(*r, 0.5, "x") for r in rows + extra], "doc_id long, text string, lang string, score double, lang_pred string")
    model = language.train(d)
    got = {r.doc_id: r for r in language.predict(d, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5 == 0)
    assert [got[i].lang_pred for i in (900, 901, 902, 903, None, 904)] == ["und", "und", "und", "fr", "de", "en"]
    assert all(0 <= r.score <= 1 for r in got.values())
    again = language.train(d.unionByName(d).unionByName(d.where("doc_id = 3")))  # repeated rows teach nothing new
    assert {r.doc_id: r.lang_pred for r in language.predict(d, again).collect()} == {i: r.lang_pred for i, r in got.items()}
    assert all(r.score == pytest.approx(got[r.doc_id].score, abs=1e-6) for r in language.predict(d, again).collect())
    assert language.train(d.where("lang is null")) is None
    assert {r.lang_pred for r in language.predict(d, None).collect()} == {"und"}
    assert language.predict(d.where("false"), model).count() == 0


def test_many_languages_and_number_signs(spark, monkeypatch):
    """80 languages are learned in one matrix of bounded size; signs that are numbers are no letters."""
    monkeypatch.setattr(language, "MARKS", 240)
    rng = random.Random(8)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    tongues = {f"l{k:02d}": ["".join(rng.choices(rng.sample(alphabet, 9), k=rng.randint(3, 8))) for _ in range(40)] for k in range(80)}
    rows = [(i, " ".join(rng.choices(tongues[lang], k=60)), lang) for i, lang in enumerate(list(tongues) * 8)]
    odd = [(9000 + i, t, None) for i, t in enumerate(("½ ²", "①", "ⅷ", "3 ½ %", "a ½"))]
    d = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    model = language.train(d)
    assert len(model.languages) == 80
    got = {r.doc_id: r.lang_pred for r in language.predict(d, model).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i] == lang for i, lang in held) > 0.9 * len(held)
    assert [got[9000 + i] for i in range(4)] == ["und"] * 4 and got[9004] != "und"


def test_kernel_machine_follows_brute_force(spark):
    """Margins against the kernel summed n-gram by n-gram and ridge regression on explicit Nystroem features of every window."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(SAMPLES[lang].split(), k=rng.randint(20, 400))), lang) for i in range(60) for lang in (rng.choice(list(SAMPLES)),)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    grams = lambda row: frozenset(np.flatnonzero(row).tolist())
    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    use = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 5]
    windows = [(grams(w), lang) for t, lang in use for w in language.presence(t)[0]]
    marks = [grams(language.presence(t)[0][zlib.crc32(t.encode()) % len(language.presence(t)[0])]) for t, _ in use]  # fewer than LANDMARKS of each
    values, vectors = np.linalg.eigh([[kernel(a, b) for b in marks] for a in marks])
    root = vectors[:, values > 1e-8 * values.max()] / np.sqrt(values[values > 1e-8 * values.max()])
    phi = np.array([[kernel(w, m) for m in marks] for w, _ in windows]) @ root
    names = sorted(SAMPLES)
    share = np.array([1 / sum(x == lang for _, x in windows) for _, lang in windows])
    y = np.array([[1.0 if lang == x else -1.0 for x in names] for _, lang in windows])
    gram = (phi * share[:, None]).T @ phi
    solved = np.linalg.solve(gram + language.RIDGE * np.eye(len(gram)) * len(names) / len(gram), (phi * share[:, None]).T @ y)
    for text in (SAMPLES["de"], SAMPLES["fr"] + " 12", "quite other words"):
        bits, length = language.presence(text)
        want = sum(n * (np.array([kernel(grams(b), m) for m in marks]) @ root @ solved) for b, n in zip(bits, length, strict=True)) / length.sum()
        assert model.margins([text])[0][0] == pytest.approx(want, abs=1e-3)


# --- shards and URLs -----------------------------------------------------------------


def test_shards(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(("alpha", "beta", None, "")) if i % 3 == 0 else f"text {i}" * rng.randint(1, 9)) for i in range(203)] + [(None, "x"), (5, "é"), (5, "é")]
    got = sharding.shard_documents(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    sizes = [len(by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(b"alpha")}) == 1
    assert sharding.shard_documents(docs(spark, [])).count() == 0
    long = sharding.shard_documents(docs(spark, [(1, "long ö" * 500_000), (2, "a"), (3, "long ö" * 500_000)])).collect()
    assert sorted(r.size for r in long) == [2, 3_500_001, 3_500_001] and len({(r.shard, r.slot) for r in long}) == 3
    few = sharding.shard_documents(docs(spark, [(1, "a"), (2, "a")])).collect()
    assert sorted(r.slot for r in few) == [0, 0]


def test_a_group_larger_than_a_shard_is_spread_evenly(spark):
    rows = [(i, "same") for i in range(90)] + [(100 + i, f"t{i}") for i in range(110)]
    got = sharding.shard_documents(docs(spark, rows)).collect()
    assert collections.Counter(collections.Counter(r.shard for r in got).values()) == {25: 8}


def test_hubs_go_through_the_propagation(spark):
    """Groups of 2 to 300 over files laid out in two ways: the same shards, and a cut that pairs counted one by one confirm."""
    rng = random.Random(5)
    sizes = [300, 40, 30] + [rng.randint(2, 12) for _ in range(60)]
    rows = [f"g{g}" for g, n in enumerate(sizes) for _ in range(n)]
    rows += [f"single {k}" for k in range(900)]
    rows = list(enumerate(rows))
    got = sharding.shard_documents(docs(spark, rows)).collect()
    rng.shuffle(rows)
    again = sharding.shard_documents(docs(spark, rows).repartition(7)).collect()
    assert {(r.doc_id, r.shard) for r in got} == {(r.doc_id, r.shard) for r in again}
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    text, shard = dict(rows), {r.doc_id: r.shard for r in got}
    by = collections.defaultdict(list)
    for i, t in text.items():
        by[t].append(i)
    links = sum(len(v) * (len(v) - 1) // 2 for v in by.values())
    apart = sum(shard[a] != shard[b] for v in by.values() for k, a in enumerate(v) for b in v[k + 1 :])
    placed = spark.createDataFrame(list(shard.items()), "node long, shard int")
    members = spark.createDataFrame([(i, zlib.crc32(t.encode())) for i, t in rows], "node long, hub long")
    assert tuple(sharding.cut(placed, members).first()) == (links, apart)
    # the group of 300 needs two shards of about 213 rows; hashing would cut seven links of eight
    assert apart - 2 * 150 * 150 < 0.02 * links < 7 / 8 * links and apart < 0.55 * links
    assert sharding.cut(placed, members.where("false")).first().links == 0


URLS = [
    ("https://a.org/x", "a.org", "/x", "org/"), ("http://www.example.ORG/es/1?x", "www.example.org", "/es/1", "example.org/es/"), ("http://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1"), ("http://example.org/en/2", "example.org", "/en/2", "org/"),
    ("https://x.com/fr/", "x.com", "/fr/", "com/fr/"), ("https://x.com/DE/1", "x.com", "/DE/1", None), ("https://com/de/1", "com", "/de/1", "com/de/"), ("https://notorg/x", "notorg", "/x", None), ("https://a.org", "a.org", "", None), ("mailto:x", "", "", None), (None, "", "", None), ("", "", "", None),
    ("a://b://c.org/p", "b:", "//c.org/p", None), ("http://x.net?q=://y.org/", "x.net", "", None), ("http://x.net/" + "a" * 20000, "x.net", "/" + "a" * 20000, None),
]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u[0], "h", "p", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, path string, score int")
    verdicts = dict((t, v) for v, t in url_filter.RULES)
    model = url_filter.train(spark)
    got = {r.page_id: r for r in url_filter.judge(df, model).collect()}
    for i, (_, host, path, rule) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdicts[rule] if rule else "block" if got[i].score >= 0.5 else "allow")
    assert url_filter.judge(df.where("false"), model).count() == 0
    plan = url_filter.judge(df, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    parts = df.select("page_id", url_filter.host(F.col("url")).alias("host"), url_filter.path(F.col("url")).alias("path"))
    many = url_filter.RULES + tuple(("allow", f"h{i}.zz/") for i in range(80))
    assert {r.page_id: r.rule for r in url_filter.apply_rules(parts, many).collect()} == {i: u[3] for i, u in enumerate(URLS)}


def test_url_table_with_quotes(spark):
    model = url_filter.train(spark, (("http://casino.example.net/it's", 1), ("http://news.example.net/a\\b\"c", 0)))
    got = url_filter.judge(spark.createDataFrame([(1, "http://casino.example.net/it's"), (2, "http://news.example.net/a\\b\"c")], "page_id long, url string"), model).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "allow"}


def test_url_model_on_other_urls(spark):
    other = [("http://mega-casino.example.net/slots/free", "block"), ("https://blog.example.net/en/5512", "allow"), ("http://xxx-teen.example.net/adult", "block"), ("https://example.net/login", "block"), ("https://www.news.example.net/2020/01/economy", "allow"), ("http://ads-track.example.net/banner", "block"), ("https://essays.example.net/books/55", "allow"), ("http://sex-chat.example.net/live", "block")]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(other)], "page_id long, url string")).collect()}
    assert [got[i] for i in range(len(other))] == [v for _, v in other]


def test_repeated_rows_are_ranked_in_many_tasks(spark, monkeypatch):
    """50,000 pieces of one id, place and length, and 50,000 rows of one id and text: every bucket of the ranking holds a share."""
    monkeypatch.setattr(common, "RANK_BUCKET_ROWS", 2_000)
    seen = []
    real = common.ranked

    def watched(df, keys, classes, order, spread, rows, out):
        buckets = max(1, rows // common.RANK_BUCKET_ROWS)
        if rows >= 50_000:
            seen.append([r["count"] for r in df.groupBy(F.pmod(F.xxhash64(*spread, F.lit(7)), F.lit(buckets))).count().collect()])
        return real(df, keys, classes, order, spread, rows, out)

    monkeypatch.setattr(common, "ranked", watched)
    same = spark.range(50_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    packed = packing.pack_documents(same, keep_ids=False)
    assert packed.count() == 50_000 and packed.select("sequence_id", "offset").distinct().count() == 50_000
    placed = sharding.shard_documents(same)
    assert placed.select("shard", "slot").distinct().count() == 50_000
    assert len(seen) >= 2 and all(max(s) < 3 * sum(s) / 25 for s in seen)


def test_url_weights_follow_a_second_regression(spark):
    """Logistic regression by gradient steps on the weights themselves, over n-grams cut in Python, against the fit in SQL on coefficients of rows."""
    table = url_filter.LABELLED[::3]
    rows = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(table)], "k int, url string")
    parts = {r.k: (r.h, r.p) for r in rows.select("k", url_filter.host(F.col("url")).alias("h"), url_filter.path(F.col("url")).alias("p")).collect()}
    grams = {k: {t[i : i + n] for n in url_filter.GRAMS for i in range(len(t) - n + 1)} for k, (h, p) in parts.items() for t in (f"^{h}|{p.lower()}$",)}
    every = sorted(set().union(*grams.values()))
    bucket = {r.g: r.b for r in spark.createDataFrame([(g,) for g in every], "g string").select("g", F.pmod(F.hash("g"), F.lit(url_filter.BUCKETS)).alias("b")).collect()}
    x = np.zeros((len(table), url_filter.BUCKETS))
    for k, found in grams.items():
        x[k, sorted({bucket[g] for g in found})] = 1
    x /= np.sqrt(x.sum(axis=1, keepdims=True))
    y, w, b = np.array([v for _, v in table], float), np.zeros(url_filter.BUCKETS), 0.0
    for _ in range(url_filter.STEPS):
        rest = y - 1 / (1 + np.exp(-(x @ w + b)))
        w, b = w * (1 - url_filter.RATE * url_filter.DECAY) + url_filter.RATE * (x.T @ rest), b + url_filter.RATE * rest.mean()
    model = url_filter.train(spark, table)
    assert model.intercept == pytest.approx(b, rel=1e-6, abs=1e-9)
    assert np.allclose(model.weights, w, rtol=1e-6, atol=1e-9) and np.abs(w).max() > 0.1
    assert ((x @ w + b > 0) == (y == 1)).mean() > 0.95
