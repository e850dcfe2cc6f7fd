"""Best-fit packing of token pieces into sequences by minimum bin slack.

Lengths are at most `CAPACITY`, so the whole problem is the histogram of
lengths: at most CAPACITY counts, whatever the number of documents.  `plan`
works on it alone.  For each bin the longest piece left is set, then a bitset
subset-sum dynamic program over the lengths left finds the fullest feasible
combination; that combination is taken as often as the counts allow and
removed.  Each time one length's count falls below what the combination needs
of it, so a length of l ends a round at most 1 + log2(CAPACITY / l) times and
the plan has a few thousand rounds at most, independent of the data's size.
Pieces get their places from their rank within their length.

Edge cases.  Null or empty text is one piece that holds the end mark alone.  A
null doc_id is kept as a row of its own.  Repeated rows are packed each.  An
empty table gives an empty result.  Texts with special-token strings or with
other than Latin letters go through the tokenizer whole; the ids are the same.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CAPACITY = 4096
END_ID = 1
#: Code points of texts that are tokenized together; one longer text is a group of its own.
GROUP_CHARS = 4_000_000
#: Bytes of the longest run that is merged in a matrix.
LONG_RUN = 96
NO_MERGE = 1 << 30

#: Latin letters whose lower case has the same number of bytes, and no composition.
_PLAIN = re.compile("[\x00-\u012f\u0131-\u017f]*+\\Z").match
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
#: Kind of each code point below U+0180, as the tokenizer's pattern divides them.
_KIND = np.array([_SPACE if chr(c).isspace() and not 0x1C <= c <= 0x1F else {"L": _LETTER, "N": _DIGIT}.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x180)], np.uint8)
#: Endings that stay with their apostrophe.
_ENDINGS = [ord(c) for c in "stmd"], [tuple(map(ord, e)) for e in ("re", "ve", "ll")]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself, or the next free one from U+0100."""
    odd = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
    return [chr(256 + odd.index(b)) if b in odd else chr(b) for b in range(256)]


def vocabulary() -> str:
    """The default vocabulary file: the installed public word-level byte-pair vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    Texts of Latin letters (`_PLAIN`), which is nearly all of most corpora, are
    cut into the tokenizer's runs of letters, digits and other marks by array
    operations over a group of texts; distinct runs are merged together, one
    merge of every run at a time, by the tokenizer's own merge table.  All
    other texts, and very long runs, go through the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        model = json.loads(self.tokenizer.to_str())["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        end = model["end_of_word_suffix"] or ""
        self.first = np.array([vocab[c] for c in byte_letters()], np.int64)
        self.last = np.array([vocab[c + end] for c in byte_letters()], np.int64)
        self.size = max(vocab.values()) + 1
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.pairs = common.HashTable({vocab[a] * self.size + vocab[b]: rank for rank, (a, b) in reversed(list(enumerate(merges)))})

    def _fresh(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids, NO_MERGE where there is none."""
        found = self.pairs.find((left * self.size + right).astype(np.uint64))
        return np.where(found >= 0, self.pairs.values[found], NO_MERGE)

    def _merge(self, runs: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs in a row, and how many each has."""
        starts = np.frombuffer(runs.buffers()[1], np.int32)[runs.offset : runs.offset + len(runs) + 1].astype(np.int64)
        data = np.frombuffer(runs.buffers()[2], np.uint8)
        length = np.diff(starts)
        count, done = np.zeros(len(runs), np.int64), []
        long = np.flatnonzero(length > LONG_RUN).tolist()
        for i, ids in zip(long, self._fresh([runs[i].as_py().decode() for i in long]), strict=True):
            done.append((np.array([i]), np.frombuffer(ids, "<u4").astype(np.int64)[None, :]))
        order = np.argsort(length, kind="stable")
        cuts = np.searchsorted(length[order], np.arange(1, LONG_RUN + 2))
        for width, rows in ((w, order[a:b]) for w, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False), 1) if a < b):
            raw = data[starts[rows][:, None] + np.arange(width)]
            ids = np.concatenate([self.first[raw[:, :-1]], self.last[raw[:, -1:]]], axis=1)
            rank = self._ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
            while ids.shape[1] > 1:  # every row left loses one id in a turn
                at = rank.argmin(axis=1)
                best = rank[np.arange(len(rows)), at]
                go = best < NO_MERGE
                if not go.all():
                    done.append((rows[~go], ids[~go]))
                    rows, ids, rank, at, best = rows[go], ids[go], rank[go], at[go], best[go]
                    if not len(rows):
                        break
                each, keep = np.arange(len(rows)), np.ones(ids.shape, bool)
                ids[each, at] = self.merged[best]
                keep[each, at + 1] = False
                ids = ids[keep].reshape(len(rows), -1)
                keep = np.ones(rank.shape, bool)
                keep[each, at] = False
                rank = rank[keep].reshape(len(rows), -1)
                before, after = np.flatnonzero(at > 0), np.flatnonzero(at < ids.shape[1] - 1)
                rank[before, at[before] - 1] = self._ranks(ids[before, at[before] - 1], ids[before, at[before]])
                rank[after, at[after]] = self._ranks(ids[after, at[after]], ids[after, at[after] + 1])
            if len(rows):
                done.append((rows, ids))
        for rows, ids in done:
            count[rows] = ids.shape[1]
        flat, place = np.empty(int(count.sum()), np.uint32), np.cumsum(count) - count
        for rows, ids in done:
            flat[place[rows][:, None] + np.arange(ids.shape[1])] = ids
        return flat, count

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that `_PLAIN` matches; for these lower-casing keeps every byte's place."""
        data = np.frombuffer(("\n".join(texts) + "\n").lower().encode(), np.uint8)
        kind = _KIND[data]
        wide = np.flatnonzero(data >= 0xC0)
        kind[wide] = kind[wide + 1] = _KIND[((data[wide] & 0x1F).astype(np.int64) << 6) | (data[wide + 1] & 0x3F)]
        start = kind != _SPACE
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        start[wide + 1] = False
        # an apostrophe alone before letters takes the ending it is part of
        mark = np.flatnonzero(start & (data == ord("'")))
        mark = mark[kind[mark + 1] == _LETTER]
        one, two = data[mark + 1], data[np.minimum(mark + 2, len(data) - 1)]
        size = np.where(np.isin(one, _ENDINGS[0]), 2, 0)
        for a, b in _ENDINGS[1]:
            size[(one == a) & (two == b)] = 3
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        start[mark + size] = kind[mark + size] != _SPACE
        solid = kind != _SPACE
        kept = np.cumsum(solid)  # bytes that are no space up to each place
        places = np.flatnonzero(start)
        starts = np.append(kept[places] - 1, kept[-1]).astype(np.int32)
        runs = pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(starts), pa.py_buffer(data[solid])]).dictionary_encode()
        flat, count = self._merge(runs.dictionary)
        of = runs.indices.to_numpy()
        many = count[of]
        ends = np.cumsum(many)
        ids = flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat((np.cumsum(count) - count)[of] - (ends - many), many)].astype("<u4").tobytes()
        to = np.searchsorted(places, np.cumsum([(len(t) if t.isascii() else len(t.encode())) + 1 for t in texts]))
        cuts = 4 * np.append(0, ends)[np.append(0, to)]
        return [ids[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain = [_PLAIN(t) is not None and "<|" not in t for t in texts]
        other = [i for i, p in enumerate(plain) if not p]
        for i, ids in zip(other, self._fresh([texts[i] for i in other]), strict=True):
            out[i] = ids
        group, chars = [], 0
        for i in [*(i for i, p in enumerate(plain) if p), None]:
            if group and (i is None or chars + len(texts[i]) > GROUP_CHARS):
                for j, ids in zip(group, self._plain([texts[j] for j in group]), strict=True):
                    out[j] = ids
                group, chars = [], 0
            if i is not None:
                group.append(i)
                chars += len(texts[i])
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    end = END_ID.to_bytes(4, "little")
    for batch in batches:
        row, piece, start, length, crc, ids = [], [], [], [], [], []
        for k, data in enumerate(enc.encode([t or "" for t in batch.column("text").to_pylist()])):
            data += end
            for i, at in enumerate(range(0, len(data), 4 * capacity)):
                part = data[at : at + 4 * capacity]
                row.append(k), piece.append(i), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
                if keep_ids:
                    ids.append(np.frombuffer(part, "<i4"))
        cols = [batch.column("doc_id").take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(ids, pa.list_(pa.int32()))] if keep_ids else cols, [*names, "ids"] if keep_ids else names)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """The token pieces of `docs` (doc_id, text): doc_id, piece, start, length, ids_crc32 and, on demand, ids."""
    path = path or vocabulary()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda it: _pieces(it, path, capacity, keep_ids), schema)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum of at most `capacity` that holds the longest."""
    longest = max(counts)
    room = capacity - longest
    taken = {longest: 1}
    mask = (1 << (room + 1)) - 1
    reach, trail = 1, []
    for size in sorted((s for s in counts if s <= room), reverse=True):
        left = min(counts[size] - (size == longest), room // size)
        step = 1
        while left > 0:
            use = min(step, left)
            left -= use
            step *= 2
            grown = (reach | reach << (use * size)) & mask
            if grown != reach:
                trail.append((size, use, reach))
                reach = grown
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    for size, use, before in reversed(trail):
        if not before >> at & 1:
            taken[size] = taken.get(size, 0) + use
            at -= use * size
    return taken


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, first sequence, pieces of it a sequence, offset of the first), for all rounds."""
    counts = {s: n for s, n in histogram.items() if n > 0}
    rank = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    while counts:
        taken = fullest(counts, capacity)
        times = min(counts[s] // n for s, n in taken.items())
        offset = 0
        for s, n in sorted(taken.items(), reverse=True):
            rows.append((s, rank[s], sequence, n, offset))
            rank[s] += n * times
            offset += n * s
            counts[s] -= n * times
            if not counts[s]:
                del counts[s]
        sequence += times
    return rows


def _places(batches: Iterator[pa.RecordBatch], rows: list[tuple[int, int, int, int, int]]) -> Iterator[pa.RecordBatch]:
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 48) + table[:, 1]
    for batch in batches:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        r = table[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
        k, j = np.divmod(rank - r[:, 1], r[:, 3])
        names = [n for n in batch.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(r[:, 2] + k), pa.array(r[:, 4] + j * length)], [*names, "sequence_id", "offset"])


def pack(pieces_: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces_` (doc_id, piece, length and others) with sequence_id and offset.

    The rows pass by once for the histogram and once for their places; no text
    or ids are shuffled if the input holds none.  A column `_row` that numbers the
    rows keeps repeated ones apart while they are ranked; it is left out.
    """
    histogram = {r[0]: r[1] for r in pieces_.groupBy("length").count().collect()}  # at most `capacity` rows
    rows = plan(histogram, capacity)
    own = [c for c in ("_row",) if c in pieces_.columns]
    numbered = common.ranked(pieces_, ["length"], [], ["doc_id", "piece", "ids_crc32", *own], ["doc_id", "piece", *own], sum(histogram.values()), "rank").drop(*own)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces_.schema if f.name not in own) + ", sequence_id long, offset long"
    return numbered.mapInArrow(lambda it: _places(it, rows), schema)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """Tokenize, cut and pack `docs`; one row per piece."""
    rows = pieces(docs, path, capacity, keep_ids).withColumn("_row", F.monotonically_increasing_id())
    return pack(common.materialize(rows, "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids (at most the capacity), doc_ids by place."""
    s = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("s"), F.sum("length").alias("n_tokens"))
    return s.select("sequence_id", "n_tokens", F.flatten("s.ids").alias("ids"), F.col("s.doc_id").alias("doc_ids"))
