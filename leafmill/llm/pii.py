"""Personal data: fixed patterns, and a character BiLSTM with a CRF that adds spans.

The base patterns (e-mail, IP, card, phone) are found in the whole text in time
linear in its length.  A bidirectional LSTM over character classes with CRF
transitions, trained here in numpy from generated labelled spans, adds what
the patterns leave out: phone numbers without a country code, dotted card
numbers, 15-digit cards.  Texts are cut into overlapping windows; each is
decoded by Viterbi, and the windows' spans are reconciled over the whole text:
the set of spans without overlap and with the largest total weight stays,
where a span weighs more the nearer it is to its window's centre and the more
windows agree.  Every kept span is checked exactly, and those that touch a
base span are dropped, so base spans always stay.

Every kind needs a digit or an @, so a window without either cannot hold a
span that passes the check; such windows are not decoded.

Edge cases.  Null and empty texts have no spans.  Positions are code points,
ends exclusive.  Repeated rows are treated each.  Extra columns are kept by
`redact` and ignored by `find`.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of every output.
KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
HIDDEN = 16
TRAIN_LINES, TRAIN_STEPS, TRAIN_BATCH, TRAIN_LENGTH, TRAIN_RATE = 4000, 500, 48, 72, 0.015

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_chain = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_part = re.compile(r"[0-9]+")
_trigger = re.compile(r"[0-9@]")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[Span]]:
    """Leftmost non-overlapping spans of each kind by the fixed patterns, those that fail their check left out."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        m = _domain.match(text, at + 1) if start < at else None
        if m:
            out["email"].append((start, m.end()))
        # a local part holds no @, so nothing before this one can start a later match
        low = m.end() if m else at + 1
        at = text.find("@", low)
    if not _part.search(text):
        return out
    for m in _chain.finditer(text):
        parts = [p.span() for p in _part.finditer(text, m.start(), m.end())]
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(s := text[a:b].lstrip("0")) <= 3 and int(s or 0) <= 255 for a, b in four):
                out["ip"].append((four[0][0], four[3][1]))
    for m in _card.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out["card"].append(m.span())
    for m in _phone.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out["phone"].append(m.span())
    return out


# --- the tagger -----------------------------------------------------------

_SIGNS = "@.-+() \n_%:/,=\"#"
_CLASSES = len(_SIGNS) + 6
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def _class_table() -> np.ndarray:
    table = np.full(256, len(_SIGNS) + 5, np.int8)
    table[ord("0") : ord("9") + 1] = 1
    table[ord("a") : ord("z") + 1] = 2
    table[ord("A") : ord("Z") + 1] = 3
    table[0xC0:0x100] = 4
    table[ord("\t")] = table[ord("\r")] = 5 + _SIGNS.index("\n")
    for i, c in enumerate(_SIGNS):
        table[ord(c)] = 5 + i
    return table


_TABLE = _class_table()


def classes(text: str) -> np.ndarray:
    """Class of every code point; 0 is kept for padding."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(c < 256, _TABLE[np.minimum(c, 255)], 4).astype(np.int8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool):
    """Hidden states (time, batch, H) of classes x (time, batch); gates kept for training."""
    steps, n = x.shape
    size = u.shape[0]
    h, c = np.zeros((n, size)), np.zeros((n, size))
    hs, trace = np.empty((steps, n, size)), []
    wx = w + b
    for t in range(steps):
        z = wx[x[t]] + h @ u
        s = _sigmoid(z[:, : 3 * size])
        i, f, o, g = s[:, :size], s[:, size : 2 * size], s[:, 2 * size :], np.tanh(z[:, 3 * size :])
        before, earlier = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        hs[t] = h
        if keep:
            trace.append((i, f, o, g, before, earlier, tc))
    return hs, trace


def _lstm_back(x: np.ndarray, u: np.ndarray, dh_all: np.ndarray, trace: list, grad_w: np.ndarray, grad_u: np.ndarray, grad_b: np.ndarray) -> None:
    dh, dc = np.zeros_like(dh_all[0]), np.zeros_like(dh_all[0])
    every = np.empty((len(trace), dh.shape[0], 4 * dh.shape[1]))
    for t in range(len(trace) - 1, -1, -1):
        i, f, o, g, before, earlier, tc = trace[t]
        dh = dh + dh_all[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = every[t]
        size = dh.shape[1]
        dz[:, :size] = dc * g * i * (1 - i)
        dz[:, size : 2 * size] = dc * before * f * (1 - f)
        dz[:, 2 * size : 3 * size] = dh * tc * o * (1 - o)
        dz[:, 3 * size :] = dc * i * (1 - g * g)
        dh, dc = dz @ u.T, dc * f
    flat = every.reshape(-1, every.shape[2])
    grad_w += np.eye(grad_w.shape[0])[x.reshape(-1)].T @ flat
    grad_u += np.concatenate([s[5] for s in trace]).T @ flat
    grad_b += flat.sum(axis=0)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Parameters of the BiLSTM-CRF; `fit` learns them, `decode` tags windows."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 17):
        rng = np.random.default_rng(seed)
        init = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {f"{k}{d}": v for d in "fb" for k, v in (("w", init(_CLASSES, 4 * hidden)), ("u", init(hidden, 4 * hidden)), ("c", np.zeros(4 * hidden)))}
        for d in "fb":
            self.p[f"c{d}"][hidden : 2 * hidden] = 1.0
        self.p |= {"out": init(2 * hidden, TAGS), "bias": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}

    def emissions(self, x: np.ndarray, keep: bool = False):
        f, tf = _lstm(x, self.p["wf"], self.p["uf"], self.p["cf"], keep)
        b, tb = _lstm(x[::-1], self.p["wb"], self.p["ub"], self.p["cb"], keep)
        h = np.concatenate([f, b[::-1]], axis=2)
        return h @ self.p["out"] + self.p["bias"], h, tf, tb

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tags y (time, batch) and its gradients."""
        e, h, tf, tb = self.emissions(x, True)
        steps, n, _ = e.shape
        move, first = self.p["move"], self.p["first"]
        a, z = np.empty_like(e), np.empty_like(e)
        a[0] = first + e[0]
        for t in range(1, steps):
            a[t] = e[t] + _lse(a[t - 1][:, :, None] + move, 1)
        z[-1] = 0
        for t in range(steps - 2, -1, -1):
            z[t] = _lse(move + (e[t + 1] + z[t + 1])[:, None, :], 2)
        total = _lse(a[-1], 1)
        hot = np.eye(TAGS)[y]
        pairs = np.einsum("tni,tnj->ij", hot[:-1], hot[1:])
        path = float((e * hot).sum() + (move * pairs).sum() + first[y[0]].sum()) / n
        de = np.exp(a + z - total[None, :, None]) - hot
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["first"] = de[0].sum(axis=0) / n
        ahead = np.exp((e + z)[1:] - total[None, :, None] / 2)
        behind = np.exp(a[:-1] - total[None, :, None] / 2)
        g["move"] = np.exp(move) * np.einsum("tni,tnj->ij", behind, ahead) - pairs
        g["move"] /= n
        de /= n
        g["out"] = np.einsum("tnh,tnk->hk", h, de)
        g["bias"] = de.sum(axis=(0, 1))
        dh = de @ self.p["out"].T
        size = dh.shape[2] // 2
        _lstm_back(x, self.p["uf"], dh[:, :, :size], tf, g["wf"], g["uf"], g["cf"])
        _lstm_back(x[::-1], self.p["ub"], dh[::-1, :, size:], tb, g["wb"], g["ub"], g["cb"])
        return float(total.mean()) - path, g

    def fit(self, sample, steps: int = TRAIN_STEPS, rate: float = TRAIN_RATE) -> Tagger:
        """Adam over `steps` batches from `sample()` -> (classes, tags), both (time, batch)."""
        m, s = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            _, g = self.gradients(*sample())
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, v in g.items():
                v = v * min(1.0, 5 / (norm + 1e-9))
                m[k] += 0.1 * (v - m[k])
                s[k] += 0.01 * (v * v - s[k])
                self.p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tags (time, batch) by Viterbi."""
        e = self.emissions(x)[0]
        steps, n, _ = e.shape
        back = np.empty((steps, n, TAGS), np.int8)
        score = self.p["first"] + e[0]
        for t in range(1, steps):
            each = score[:, :, None] + self.p["move"]
            back[t] = each.argmax(axis=1)
            score = each.max(axis=1) + e[t]
        tags = np.empty((steps, n), np.int8)
        tags[-1] = score.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(n), tags[t]]
        return tags


def _example(rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A line of invented text with labelled spans among look-alikes."""
    num = lambda n: "".join(rng.choices("0123456789", k=n))
    pick = lambda *a: rng.choice(a)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 9)))

    def email() -> str:
        local = word() + pick("", f".{word()}", f"_{word()}", f"-{num(2)}", f".{num(2)}", f"+{word()}")
        return f"{local}@{word()}{pick('', num(1), '-' + word())}.{pick('com', 'org', 'net', 'example.com', word() + '.de')}"

    def ip() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    def card() -> str:
        d = num(14 if rng.random() < 0.15 else 15)
        d += next(str(k) for k in range(10) if luhn(d + str(k)))
        sep = pick("", "", " ", "-", ".")
        return sep.join([d[:4], d[4:10], d[10:]] if len(d) == 15 else [d[i : i + 4] for i in range(0, 16, 4)])

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return pick(f"+{pick('1', '49', '33', '34')} ({a}) {b}-{c}", f"+{num(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}", f"+{num(11)}")

    def other() -> str:
        y = str(rng.randint(1900, 2099))
        return pick(y, num(rng.randint(1, 5)), f"{num(1)}.{num(1)}.", f"{num(1)}.{num(2)}.{num(1)}", f"{y}-{num(2)}-{num(2)}", f"{num(2)}:{num(2)}", f"{num(1)},{num(3)}.{num(2)}", f"{num(2)}.{num(2)}.{y}", f"#{num(5)}", "".join(rng.choices("0123456789abcdef", k=rng.randint(12, 39))), f"password={num(2)}{word()}{num(3)}", f"AKIA{word().upper()}{num(2)}", f"@{word()}", f"{num(4)}-{num(4)}", f"p. {num(2)}-{num(2)}", f"id={num(9)}", f"https://{word()}.com/{num(4)}?p={num(2)}")

    make = {"email": email, "ip": ip, "card": card, "phone": phone}
    text, spans = "", []
    while len(text) < TRAIN_LENGTH + 20:
        r = rng.random()
        if r < 0.28:
            kind = pick(*KINDS)
            piece = make[kind]()
            spans.append((kind, len(text), len(text) + len(piece)))
        elif r < 0.5:
            piece = other()
        else:
            piece = word()
            piece = piece.capitalize() if rng.random() < 0.1 else "é" + piece if rng.random() < 0.08 else piece
        text += piece + pick(" ", " ", " ", " ", " ", ", ", ". ", ".\n", "; ", ": ", " - ")
    return text, spans


def tags_of(length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    y = np.zeros(length, np.int8)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        y[a:b] = k + 1
        y[a] = k
    return y


@lru_cache(maxsize=2)
def trained(steps: int = TRAIN_STEPS, seed: int = 17) -> Tagger:
    """The tagger after `steps` batches of generated labelled lines; the same on every machine."""
    rng = random.Random(seed)
    lines = [_example(rng) for _ in range(TRAIN_LINES)]
    xs, ys = [classes(t) for t, _ in lines], [tags_of(len(t), sp) for t, sp in lines]
    draw = np.random.default_rng(seed)

    def sample():
        at = [(k, int(draw.integers(0, len(xs[k]) - TRAIN_LENGTH + 1))) for k in draw.integers(0, len(xs), TRAIN_BATCH).tolist()]
        return tuple(np.stack([v[k][s : s + TRAIN_LENGTH] for k, s in at], axis=1) for v in (xs, ys))

    return Tagger(seed=seed).fit(sample, steps)


def _spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the spans in one window's tags; a window may open inside a span."""
    out, t = [], 0
    while t < len(tags):
        if tags[t] % 2 == 1 or t == 0 and tags[t]:
            kind, end = (int(tags[t]) - 1) // 2, t + 1
            while end < len(tags) and tags[end] == 2 * kind + 2:
                end += 1
            out.append((kind, t, end))
            t = end
        else:
            t += 1
    return out


_plain_phone = re.compile(r"\(?[0-9][\x20().0-9-]+[0-9]|\+[0-9][\x20().0-9-]+[0-9]")
_plain_card = re.compile(r"[0-9](?:[\x20.-]?[0-9])+")
_plain_email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def holds(kind: str, s: str) -> bool:
    """Whether a tagged string can be of its kind: the exact check after the tagger."""
    d = _digits(s)
    if kind == "email":
        return bool(_plain_email.fullmatch(s))
    if kind == "ip":
        parts = s.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 15 <= len(d) <= 19 and bool(_plain_card.fullmatch(s)) and luhn(d)
    return 10 <= len(d) <= 15 and len(d) < len(s) and bool(_plain_phone.fullmatch(s)) and s.count("(") == s.count(")")


def reconcile(found: dict[tuple[int, int, int], float]) -> list[tuple[int, int, int]]:
    """The non-overlapping spans (kind, start, end) with the largest total weight, by start."""
    spans = sorted(found, key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in spans]
    best, take = [0.0] * (len(spans) + 1), [False] * len(spans)
    before = np.searchsorted(ends, [s[1] for s in spans], side="right").tolist()
    for i, s in enumerate(spans):
        with_it = best[before[i]] + found[s]
        take[i] = with_it > best[i]
        best[i + 1] = max(best[i], with_it)
    out, i = [], len(spans)
    while i:
        if take[i - 1]:
            out.append(spans[i - 1])
            i = before[i - 1]
        else:
            i -= 1
    return out[::-1]


def model_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, int]]]:
    """Reconciled spans (kind, start, end) of each text, before the exact check."""
    where, parts = [], []
    for k, text in enumerate(texts):
        if not _trigger.search(text):
            continue
        at = sorted({w for m in _trigger.finditer(text) for w in (m.start() // STRIDE, m.start() // STRIDE - 1) if w >= 0})
        c = classes(text)
        for w in at:
            where.append((k, w * STRIDE))
            part = c[w * STRIDE : w * STRIDE + WINDOW]
            parts.append(np.pad(part, (0, WINDOW - len(part))))
    found: list[dict[tuple[int, int, int], float]] = [{} for _ in texts]
    for lo in range(0, len(parts), 1024):
        tags = tagger.decode(np.stack(parts[lo : lo + 1024], axis=1)).T
        for (k, start), row in zip(where[lo : lo + 1024], tags, strict=True):
            for kind, a, b in _spans_of(row):
                if b <= len(texts[k]) - start and (a > 0 or start == 0) and (b < WINDOW or start + b == len(texts[k])):
                    key = (kind, start + a, start + b)
                    found[k][key] = found[k].get(key, 0.0) + (b - a) * (1 - abs((a + b) / 2 - WINDOW / 2) / WINDOW)
    return [reconcile(f) for f in found]


def all_spans(texts: list[str | None], tagger: Tagger) -> tuple[list[dict[str, list[Span]]], list[dict[str, list[Span]]]]:
    """For each text the base spans, and base and added spans, by kind in order of start."""
    whole = [t or "" for t in texts]
    base = [base_spans(t) for t in whole]
    out = []
    for text, own, added in zip(whole, base, model_spans(whole, tagger), strict=True):
        every = {k: list(v) for k, v in own.items()}
        if added:
            held = sorted(s for v in own.values() for s in v)
            starts = [s[0] for s in held]
            reach = np.maximum.accumulate([0, *(s[1] for s in held)])
            for kind, a, b in added:
                # free of base spans: those that start before the end all end before the start
                if holds(KINDS[kind], text[a:b]) and reach[np.searchsorted(starts, b)] <= a:
                    every[KINDS[kind]].append((a, b))
            every = {k: sorted(v) for k, v in every.items()}
        out.append(every)
    return base, out


def listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def _find(batches: Iterator[pa.RecordBatch], tagger: Tagger) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        texts = batch.column("text").to_pylist()
        base, every = [], []
        for at in range(0, len(texts), 512):
            b, e = all_spans(texts[at : at + 512], tagger)
            base += b
            every += e
        counts = [pa.array([len(b[k]) for b in base], pa.int64()) for k in KINDS]
        digest = pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, digest, pa.array([listed(e) for e in every])], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def find(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256 and all spans as kind:start:end of `docs` (doc_id, text)."""
    tagger = tagger or trained()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lambda it: _find(it, tagger), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans: dict[str, list[Span]]) -> str:
    """The text with every span replaced by its kind in angle brackets; where kinds overlap the first and longest wins."""
    out, at = [], 0
    for a, b, k in sorted(((a, b, k) for k in KINDS for a, b in spans[k]), key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], f"<{k.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _redact(batches: Iterator[pa.RecordBatch], tagger: Tagger) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        new: list[str | None] = []
        for at in range(0, len(texts), 512):
            part = texts[at : at + 512]
            new += [None if t is None else redacted(t, s) if any(s.values()) else t for t, s in zip(part, all_spans(part, tagger)[1], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names], batch.schema.names)


def redact(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """`docs` with personal data in text replaced by <EMAIL>, <IP>, <CARD> or <PHONE>; other columns unchanged."""
    tagger = tagger or trained()
    return docs.mapInArrow(lambda it: _redact(it, tagger), docs.schema)
