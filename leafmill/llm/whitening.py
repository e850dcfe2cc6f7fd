"""Whitening of embeddings by a compensated covariance.

Every sum is kept as an unevaluated pair (high, low) of doubles, about 106 bits:
products and sums go through error-free transformations (Dekker's product,
Knuth's sum), so rounding errors of single operations are not lost but carried
in the low part.  `fit` reads the vectors twice: sums give the mean, then each
task adds up outer products of vectors centred by that mean, block by block of
BLOCK vectors.  What tasks have added up is merged, high and low parts together,
in groups of FAN tasks, and those again, so that no group grows with the input;
the driver gets the last sums alone: a number for each pair of dimensions.

The symmetric matrix is solved by LAPACK's divide and conquer (`numpy.linalg.eigh`:
Householder reduction to tridiagonal form, then rank-one tearing of the
tridiagonal matrix), which is as good as the working precision of the largest
eigenvalue.  Two steps of iterative refinement in extended precision against the
pair-valued matrix make every well separated component good to double precision.

`whiten` projects centred vectors on the components; `identity_error` adds up
the outer products of what comes out, to show how far its covariance is off.

Vectors of different lengths are different spaces: each length has its own mean,
covariance and components.

Edge cases.  A null vector, and one with a null, NaN or infinite entry, is left
out.  An empty vector stays in no space: it has no component, so no row.  Repeated
rows count each; a null id is kept.  A component without variance (a single vector,
equal vectors, more dimensions than vectors) has whitened null and explained 0, or
null where there is no variance at all, and does not enter `identity_error`.  Where
eigenvalues tie, components are one orthonormal basis of their space, the same
for all rows.  An empty table gives no rows.  Entries of the query's integers
beyond 2**52 are held at 2**52; of other entries the squares must not overflow.  Columns other than the id and the vector are left
out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors whose products are added up together.
BLOCK = 512
#: Tasks whose sums meet in one group.
FAN = 32
#: Part of the largest eigenvalue, times the dimensions, below which a component has no variance.
NO_VARIANCE = 1e-14
COMPONENTS = 8
SCALE, SHIFT, LIMIT = 1024, 100_000, float(1 << 52)

Prepare = Callable[[np.ndarray], np.ndarray]


# --- pairs of doubles ---------------------------------------------------------


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a + b as its rounded value and the exact rest."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a as two numbers of 26 bits at most, whose products are exact."""
    with np.errstate(over="ignore"):
        c = a * 134217729.0
    high = c - (c - a)
    return high, a - high


def add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of two pairs."""
    s, e = two_sum(a[0], b[0])
    t, f = two_sum(a[1], b[1])
    s, e = two_sum(s, e + t)
    return two_sum(s, e + f)


def total(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of pairs along the last axis, by halves."""
    n = high.shape[-1]
    if not n:
        return np.zeros(high.shape[:-1]), np.zeros(high.shape[:-1])
    while n > 1:
        half = n // 2
        s, e = add((high[..., :half], low[..., :half]), (high[..., half : 2 * half], low[..., half : 2 * half]))
        if n % 2:
            s, e = np.concatenate([s, high[..., -1:]], -1), np.concatenate([e, low[..., -1:]], -1)
        high, low, n = s, e, n - half
    return high[..., 0], low[..., 0]


def outer_sums(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of products of all pairs of rows of a pair-valued matrix (dimension x vectors): the upper triangle, row by row."""
    a, b = split(high)
    sums = []
    for i in range(len(high)):
        p = high[i] * high[i:]
        e = ((a[i] * a[i:] - p) + a[i] * b[i:] + b[i] * a[i:]) + b[i] * b[i:]
        sums.append(total(p, e + (high[i] * low[i:] + low[i] * high[i:])))
    return np.concatenate([s[0] for s in sums]), np.concatenate([s[1] for s in sums])


# --- sums over a table ----------------------------------------------------------


def usable(vector: str) -> F.Column:
    """True for vectors without a null, NaN or infinite entry."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of the vectors of each length in a list column without nulls."""
    lengths, flat = column.value_lengths().to_numpy(), column.flatten().to_numpy().astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths).tolist():
        if d:
            rows = np.flatnonzero(lengths == d)
            yield rows, flat[starts[rows][:, None] + np.arange(d)]


SUMS = "d int, part long, n long, high array<double>, low array<double>"


def sums(df: DataFrame, vector: str, of: Callable[[int, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """For each length d of vectors their number and a pair-valued sum over the table; `of(d, matrix)` gives a block's."""

    def each_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for _, matrix in matrices(batch.column(0)):
                d = matrix.shape[1]
                for at in range(0, len(matrix), BLOCK):
                    block = matrix[at : at + BLOCK]
                    high, low = of(d, block)
                    n, *before = held.get(d, (0, np.zeros_like(high), np.zeros_like(high)))
                    held[d] = (n + len(block), *add((before[0], before[1]), (high, low)))
        part = TaskContext.get().partitionId()
        yield from (row(d, part, *x) for d, x in held.items())

    def row(d: int, part: int, n: int, high: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
        kinds = {"d": pa.int32(), "part": pa.int64(), "n": pa.int64(), "high": pa.list_(pa.float64()), "low": pa.list_(pa.float64())}
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((d, part, n, high, low), kinds.values(), strict=True)], list(kinds))

    def meet(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")  # the same order, whatever came first
        high, low = (np.stack([x.values.to_numpy() for x in rows.column(c)], -1) for c in ("high", "low"))
        d, part, n = rows.column("d")[0].as_py(), rows.column("part")[0].as_py(), sum(rows.column("n").to_pylist())
        return pa.Table.from_batches([row(d, part // FAN, n, *total(high, low))])

    one = df.select(vector)
    tasks = one.rdd.getNumPartitions()
    held = one.mapInArrow(each_task, SUMS)
    while tasks > 1:
        held = held.groupBy("d", F.floor(F.col("part") / FAN)).applyInArrow(meet, SUMS)
        tasks = -(-tasks // FAN)
    out: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for r in held.orderBy("d", "part").collect():  # a row for each length
        part = np.array(r["high"]), np.array(r["low"])
        n, *before = out.get(r["d"], (0, np.zeros_like(part[0]), np.zeros_like(part[0])))
        out[r["d"]] = (n + r["n"], *add((before[0], before[1]), part))
    return out


# --- the model --------------------------------------------------------------------


def refined(vectors: np.ndarray, high: np.ndarray, low: np.ndarray, steps: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors (columns) of the symmetric matrix high + low, from a first guess, in extended precision.

    Each step corrects the vectors by the residuals of orthogonality and of the
    eigenvalue equation; inside clusters, where the latter says nothing, by the former alone.
    """
    x, a = vectors.astype(np.longdouble), high.astype(np.longdouble) + low
    for _ in range(steps):
        r, s = np.eye(len(x)) - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        gap = values[None, :] - values[:, None]
        off = s - np.diag(values)
        clear = np.abs(gap) > 2 * (np.abs(off).sum(axis=1).max() + np.abs(values).max() * np.abs(r).sum(axis=1).max())
        x = x + x @ np.where(clear, (s + values[None, :] * r) / np.where(clear, gap, 1), r / 2)
    return values.astype(np.float64), x.astype(np.float64)


@dataclass(frozen=True)
class Space:
    """Mean (a pair), exact sums where the entries are whole numbers, and components of the vectors of one length."""

    n: int
    sums: list[int]
    mean: tuple[np.ndarray, np.ndarray]
    components: np.ndarray  # a row each, by falling eigenvalue
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`x` (vectors x dimensions) less the mean, as a pair."""
        s, e = two_sum(x, -self.mean[0])
        return two_sum(s, e - self.mean[1])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of `x` in units of standard deviation, NaN without variance."""
        live = self.values > 0
        high, low = self.centred(x)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (high @ self.components.T + low @ self.components.T) / np.sqrt(self.values)
        return np.where(live, out, np.nan)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact for integer entries; None where 64 bits do not hold it."""
        whole, sums_ = x.astype(np.int64), np.array(self.sums, object)
        if len(x) and int(np.abs(whole).max()) * self.n * 2 < 1 << 62:
            off = whole * self.n - sums_.astype(np.int64)
            if float(np.abs(off).max()) ** 2 * off.shape[1] < 2.0**62:
                return (off * off).sum(axis=1).tolist()
            off = off.astype(object)
        else:
            off = whole.astype(object) * self.n - sums_
        return [v if v < 1 << 63 else None for v in (off * off).sum(axis=1).tolist()]


def _same(x: np.ndarray) -> np.ndarray:
    return x


def fit(df: DataFrame, vector: str, prepare: Prepare = _same, components: int = COMPONENTS, whole: bool = False) -> dict[int, Space]:
    """The space of each length of the usable vectors of `df`, whose entries go through `prepare` first; `whole`: they are whole numbers then."""
    rows = df.where(usable(vector))
    first = sums(rows, vector, lambda d, m: total(prepare(m).T, np.zeros_like(m.T)))
    means = {}
    for d, (n, high, low) in first.items():
        q = high / n
        p = q * n
        (qh, ql), (nh, nl) = split(q), split(np.float64(n))
        e = ((qh * nh - p) + qh * nl + ql * nh) + ql * nl
        means[d] = two_sum(q, ((high - p) - e + low) / n)
    blank = {d: Space(first[d][0], [], mean, np.zeros((0, d)), np.zeros(0), 0.0) for d, mean in means.items()}

    def products(d: int, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high, low = blank[d].centred(prepare(m))
        return outer_sums(np.ascontiguousarray(high.T), np.ascontiguousarray(low.T))

    spaces = {}
    for d, (n, high, low) in sums(rows, vector, products).items():
        upper = np.triu_indices(d)
        both = []
        for part in (high, low):
            matrix = np.zeros((d, d))
            matrix[upper] = part
            both.append(matrix + np.triu(matrix, 1).T)
        cov = (both[0].astype(np.longdouble) + both[1]) / n
        rounded = cov.astype(np.float64)
        values, vectors = refined(np.linalg.eigh(rounded)[1], rounded, (cov - rounded).astype(np.float64))
        order = np.argsort(-values, kind="stable")[:components]
        values, vectors = values[order], vectors[:, order].T
        signs = np.sign(vectors[np.arange(len(order)), np.abs(vectors).argmax(axis=1)])
        live = values > NO_VARIANCE * d * max(values[0], 0.0)
        exact = [int(h) + int(t) for h, t in zip(*first[d][1:], strict=True)] if whole else []
        spaces[d] = Space(n, exact, means[d], vectors * signs[:, None], np.where(live, values, 0.0), float(np.trace(cov)))
    return spaces


def identity_error(df: DataFrame, vector: str, spaces: dict[int, Space], prepare: Prepare = _same) -> dict[int, float]:
    """For each length the largest entry, without sign, of the covariance of whitened vectors less the identity.

    Whitened vectors are centred already; what is left of their mean is taken off the covariance.
    """
    held = {d: np.flatnonzero(s.values > 0) for d, s in spaces.items()}

    def products(d: int, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = np.ascontiguousarray(spaces[d].whitened(prepare(m))[:, held[d]].T)
        w = np.concatenate([w, np.ones((1, len(m)))])  # the products with ones are the sums
        return outer_sums(w, np.zeros_like(w))

    out = {d: 0.0 for d in spaces}
    for d, (n, high, low) in sums(df.where(usable(vector)), vector, products).items():
        k = len(held[d])
        matrix = np.zeros((k + 1, k + 1))
        matrix[np.triu_indices(k + 1)] = (high + low) / n
        mean = matrix[:k, k]
        out[d] = float(np.abs(np.triu(matrix[:k, :k] - np.outer(mean, mean) - np.eye(k))).max(initial=0.0))
    return out


ROWS = "component int, n long, deviation long, whitened double, explained double"


def whiten(df: DataFrame, vector: str, spaces: dict[int, Space], key: str, prepare: Prepare = _same) -> DataFrame:
    """A row for each usable vector of `df` and component: key, component (from 1), n, deviation, whitened, explained, and d, the vector's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in matrices(batch.column(1)):
                d = matrix.shape[1]
                space, x = spaces[d], prepare(matrix)
                w = space.whitened(x)
                k = w.shape[1]
                repeat = np.repeat(np.arange(len(rows)), k)
                deviation = pa.array(space.deviation(x), pa.int64()) if space.sums else pa.nulls(len(rows), pa.int64())
                explained = pa.array(np.tile(space.values / space.trace, len(rows))) if space.trace > 0 else pa.nulls(len(repeat), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows[repeat])), pa.array(np.full(len(repeat), d, np.int32)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(repeat), space.n, np.int64)), deviation.take(pa.array(repeat)), pa.array(w.ravel(), from_pandas=True), explained,
                    ],
                    [key, "d", "component", "n", "deviation", "whitened", "explained"],
                )

    kind = df.schema[key].dataType.simpleString()
    return df.where(usable(vector)).select(key, vector).mapInArrow(run, f"{key} {kind}, d int, {ROWS}")


def integers(c: np.ndarray) -> np.ndarray:
    """The query's entries: floor(1024 c) + 100000, whole numbers as doubles."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * c), -LIMIT, LIMIT - SHIFT) + SHIFT


def whitened_embeddings(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, d of the integers of every usable vector."""
    rows = df.select(key, vector)
    spaces = fit(rows, vector, integers, components, whole=True)
    errors = identity_error(rows, vector, spaces, integers)
    out = whiten(rows, vector, spaces, key, integers)
    error = F.lit(None).cast("double")
    if errors:  # an entry for each length of vectors
        error = F.element_at(F.create_map(*[F.lit(x) for d, e in errors.items() for x in (d, e)]), F.col("d"))
    return out.withColumn("identity_error", error)
