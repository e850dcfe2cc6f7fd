"""Document fingerprints by SpotSigs.

A spot signature is an anchor with the next `CHAIN` content words after it,
common words skipped.  Anchors are the common words, words whose hash is
divisible by `RARE` (so texts in languages without a word list have anchors
too) and the start of the text; boilerplate between passages of prose holds few
of them, so it hardly counts.  A fingerprint is the sorted set of a text's
hashed signatures in hexadecimal; its likeness to another is their Jaccard
similarity.

Comparison for a threshold is pruned: sets are partitioned by length, and sets of
partitions too far apart for a likeness of `at_least` are not compared; counting
goes by ranges of hashes and stops once the rest cannot reach it.  So
`fingerprints` decides whether texts are near (`NEAR`); the likeness that it
returns besides is counted whole, however small it is.

`near_pairs` joins a whole table: equal sets are one set, sets are partitioned
by length so that only neighbouring partitions can hold pairs, and within them
only the rarest signatures of each set, as many as a pair at the threshold
cannot all miss, are posted.

Edge cases.  Null is the empty text.  A text with fewer content words than a
chain has them (or, without any, its first common words) after the start as its
one signature; a text without words has none, and two such are alike (1).
Equal texts have equal fingerprints.  Rows with equal doc_id stand in order of
their text in one task; null ids come last.  A single row is its own neighbour.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CHAIN = 2
#: One word in so many is an anchor by its hash.
RARE = 16
#: Likeness from which texts are near; elements that are counted between two looks at the bound.
NEAR, RANGE = 0.5, 256
#: Common words of four languages.
COMMON = frozenset(
    "the of and to in a is that it was for on are as with his they at be this have from or had by not but what all were we when your can said there "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son "
    "el y los las por con una su para como al lo del más pero sus le ha me sin este ya cuando muy".split()
)

_words = re.compile(r"[^\W_]+").findall


def signatures(text: str | None) -> np.ndarray:
    """Sorted distinct signature hashes (uint32) of the whole text."""
    words = _words(text.lower()) if text else []
    if not words:
        return np.empty(0, np.uint32)
    content: list[str] = []
    anchors: list[tuple[str, int]] = []
    for w in words:
        if w in COMMON:
            anchors.append((w, len(content)))
        else:
            content.append(w)
            if zlib.crc32(w.encode("utf-8", "surrogatepass")) % RARE == 0:
                anchors.append((w, len(content)))
    last = len(content) - CHAIN
    found = {f"{a} {' '.join(content[j : j + CHAIN])}" for a, j in anchors if j <= last}
    found.add(f"^ {' '.join((content or words)[:CHAIN])}")
    return np.unique(np.fromiter((xxhash.xxh32_intdigest(s.encode("utf-8", "surrogatepass")) for s in found), np.uint32, len(found)))


def fingerprint(sigs: np.ndarray) -> str:
    return sigs.astype(">u4").tobytes().hex()


def partition(n: int, at_least: float) -> int:
    """Partition of sets of n elements: sets at least so alike lie in one partition or in neighbouring ones."""
    return int(math.log(n) / math.log(1 / at_least) + 1e-9)


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity of two sorted signature sets; 0 as soon as it must be below `at_least`."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    if len(a) > len(b):
        a, b = b, a
    if at_least > 0 and (abs(partition(len(a), at_least) - partition(len(b), at_least)) > 1 or len(a) < at_least * len(b)):
        return 0.0
    needed = at_least / (1 + at_least) * (len(a) + len(b))  # elements that both must hold
    both, at = 0, 0
    for lo in range(0, len(a), RANGE):
        part = a[lo : lo + RANGE]
        to = int(np.searchsorted(b, part[-1], side="right"))
        both += int(np.isin(part, b[at:to], assume_unique=True).sum())
        at = to
        if both + min(len(a) - lo - len(part), len(b) - at) < needed - 1e-9:
            return 0.0
    value = both / (len(a) + len(b) - both)
    return value if value >= at_least else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the next."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_is_near boolean, next_is_near boolean"


def _row(doc_id, text: str, sigs: np.ndarray, next_text: str, next_sigs: np.ndarray) -> tuple:
    new = edited(text, next_text)
    other = signatures(new)
    return doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(sigs), fingerprint(other), likeness(sigs, other), likeness(sigs, next_sigs), likeness(sigs, other, NEAR) > 0, likeness(sigs, next_sigs, NEAR) > 0


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in _OUT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 9, types, strict=True)], names)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finish each row with the row after it: rows by part and descending id, after each part the row that follows it."""
    held, part, rows = None, None, []
    for batch in batches:
        for doc_id, text, own, guest in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "part", "guest")), strict=True):
            if own == part and held is None:
                continue  # the part is closed; the same row again
            text = text or ""
            sigs = signatures(text)
            if own == part:
                rows.append(_row(*held, text, sigs))
            held, part = None if guest else (doc_id, text, sigs), own
        yield _batch(rows)
        rows = []


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and its edited text, and their likeness (see `_OUT`).

    Ids are cut into parts by quantiles.  The row with a part's largest id also
    goes to the part above (the largest of all to the lowest), where it stands
    last; so one exchange brings each row next to the one that follows it, and
    a part is read in order with one row held.
    """
    spark = docs.sparkSession
    exchange = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / (4 * exchange) for i in range(1, 4 * exchange)]
    found = docs.agg(F.percentile_approx("doc_id", cuts, 10_000).alias("q")).first()["q"]  # one number for each part
    bounds = F.array(*[F.lit(x) for x in sorted(set(found or []))]).cast("array<long>")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = docs.withColumn("part", F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(bounds, lambda x: x < F.col("doc_id")))))
    tops = sorted((r["part"], r["top"]) for r in rows.groupBy("part").agg(F.max("doc_id").alias("top")).collect())
    above = {top: tops[(i + 1) % len(tops)][0] for i, (_, top) in enumerate(tops)}
    also = F.lit(None).cast("int")
    if above:
        table = F.create_map(*[F.lit(x) for top, part in above.items() if top is not None for x in (top, part)]) if set(above) - {None} else None
        also = F.get(F.array(F.try_element_at(table, F.col("doc_id"))), F.lit(0)).cast("int") if table is not None else also
        if None in above:
            also = F.when(F.col("doc_id").isNull(), F.lit(above[None])).otherwise(also)
    places = F.filter(F.array(F.struct(F.col("part"), F.lit(0).alias("guest")), F.struct(also.alias("part"), F.lit(1).alias("guest"))), lambda p: p["part"].isNotNull())
    dealt = rows.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.part", "p.guest")
    ordered = dealt.repartition(exchange, "part").sortWithinPartitions("part", "guest", F.desc("doc_id"), "text")
    return ordered.mapInArrow(_neighbours, _OUT)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sigs = [signatures(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.astype(np.int64) for s in sigs], pa.list_(pa.int64()))], ["doc_id", "sigs"])


def near_pairs(docs: DataFrame, at_least: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs (a, b, jaccard) of set representatives, and each doc_id's representative.

    Documents without words are in no pair; copies are listed in members once.
    """
    signed = common.materialize(docs.select("doc_id", "text").mapInArrow(_signed, "doc_id long, sigs array<long>").where("size(sigs) > 0 and doc_id is not null"), "signed")
    sets = signed.groupBy("sigs").agg(F.min("doc_id").alias("rep"))
    members = signed.join(sets, "sigs").select("doc_id", "rep")
    sets = common.materialize(sets, "signed-sets")
    many = sets.select("rep", F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    ranked = sets.select("rep", F.size("sigs").alias("n"), F.explode("sigs").alias("sig")).join(many, "sig").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("s"))
    prefix = ranked.select("rep", "n", F.explode(F.slice(F.col("s.sig"), F.lit(1), F.col("n") - F.ceil(F.lit(at_least) * F.col("n")).cast("int") + 1)).alias("sig"))
    # a pair's lengths differ by a factor of 1 / at_least at most: the same length partition or the next
    posted = prefix.withColumn("part", F.floor(F.log(F.col("n")) / math.log(1 / at_least)).cast("int"))
    left = posted.select("sig", F.col("rep").alias("a"), F.col("n").alias("na"), F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    right = posted.select("sig", F.col("rep").alias("b"), F.col("n").alias("nb"), "part")
    order = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    found = left.join(right, ["sig", "part"]).where(order & (F.col("na") >= F.lit(at_least) * F.col("nb"))).select("a", "b").distinct()
    full = sets.select("rep", "sigs")
    both = found.join(full.withColumnsRenamed({"rep": "a", "sigs": "sa"}), "a").join(full.withColumnsRenamed({"rep": "b", "sigs": "sb"}), "b")
    common_ = F.size(F.array_intersect("sa", "sb"))
    scored = both.withColumn("jaccard", common_ / (F.size("sa") + F.size("sb") - common_)).where(F.col("jaccard") >= at_least)
    return scored.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "jaccard"), members
