"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Every entry becomes an integer, equal vectors are fitted once (``distinct``
combines copies before the shuffle), and three passes over the stored fit list
give its exact sums, the scatter of its centred vectors and, at the end, the
covariance of what was whitened.  Each pass leaves one d x d block a partition,
added up in Spark by matrix row.  The driver holds d x d numbers for vectors of
d entries, whatever the number of rows.

The scatter A is factored with pivoting, A = L Lt with the rows of L in pivot
order undone, up to its numerical rank.  Rotations from the right make the
columns of L orthogonal (one-sided Jacobi, disjoint pairs of a round together):
their squared norms are the eigenvalues of A, the columns divided by their norms
the components.  No eigenvalue is formed from the scatter itself, so small ones
keep their relative accuracy.

Defined results: rows whose vector is null or holds a null or non-finite entry
are left out, and so are those with an entry that no long can hold after scaling
(2^55 or more in size).  Vectors of different lengths lie in different spaces:
each length is fitted on its own.  Directions without variance (a component of
no more than ``TINY`` of the largest eigenvalue) cannot be whitened and have no
component; so a length with a single distinct vector, and the empty vector, give
no rows.  ``deviation`` is null where a long cannot hold it.  Repeated rows are
all returned, null ids too; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import stored, table

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: entries of this size and more have no x
LARGEST = float(1 << 55)
#: least eigenvalue of a component, of the largest one
TINY = 1e-11
#: rows of a batch that are worked on at once
SLICE = 4096


def integers(vectors: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and x (array<long>) of the usable rows of ``vectors`` (embedding)."""
    usable = vectors.where(F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST)))
    return usable.select(*keep, F.transform("embedding", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + F.lit(SHIFT)).alias("x"))


def matrices(batches, *columns: str):
    """(length, matrix of x, the given columns) of rows with equally long vectors."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            x = part.column("x")
            if not isinstance(x, pa.ListArray):
                x = x.cast(pa.list_(pa.int64()))
            sizes = np.diff(x.offsets.to_numpy())
            flat = x.flatten().to_numpy(zero_copy_only=False)
            first = np.cumsum(sizes) - sizes
            own = [part.column(c) for c in columns]
            for d in np.unique(sizes):
                rows = np.flatnonzero(sizes == d)
                yield int(d), flat[first[rows][:, None] + np.arange(d)], [c.take(pa.array(rows)) for c in own]


def _sums(batches):
    """Per length: n and the exact sum of each dimension, in two halves of 32 bits."""
    n, high, low = {}, {}, {}
    for d, x, _ in matrices(batches):
        n[d] = n.get(d, 0) + len(x)
        high[d] = high.get(d, 0) + (x >> 32).sum(axis=0)
        low[d] = low.get(d, 0) + (x & 0xFFFFFFFF).sum(axis=0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(n), pa.int32()), pa.array(list(n.values()), pa.int64()), pa.array([v.tolist() for v in high.values()], pa.list_(pa.int64())), pa.array([v.tolist() for v in low.values()], pa.list_(pa.int64()))],
        ["d", "n", "high", "low"],
    )


def moments(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Length -> n and exact sums S; one row per length and dimension."""
    parts = fit.mapInArrow(_sums, "d int, n long, high array<long>, low array<long>")
    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = parts.select("d", F.posexplode(F.arrays_zip("high", "low")).alias("j", "s")).groupBy("d", "j").agg(big("s.high").alias("high"), big("s.low").alias("low"))
    of = {r["d"]: (r["n"], [0] * r["d"]) for r in parts.groupBy("d").agg(F.sum("n").alias("n")).collect() if r["d"]}
    for r in sums.collect():
        of[r["d"]][1][r["j"]] = (int(r["high"]) << 32) + int(r["low"])
    return of


def means(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whole part and remainder of S / n, so that x minus the mean loses nothing."""
    whole = [s // n for s in sums]
    return np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(sums, whole, strict=True)])


def centred(x: np.ndarray, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    return (x - whole).astype(np.float64) - part


def _products(project):
    def run(batches):
        total = {}
        for d, x, _ in matrices(batches):
            if (w := project(d, x)) is not None:
                total[d] = total.get(d, 0) + w.T @ w
        for d, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()), pa.array(m.tolist(), pa.list_(pa.float64()))], ["d", "i", "v"])

    return run


def products(fit: DataFrame, project) -> dict[int, np.ndarray]:
    """Length -> sum of wt w over the rows w = project(length, x) of the fit list."""
    parts = fit.mapInArrow(_products(project), "d int, i int, v array<double>")
    cells = parts.select("d", "i", F.posexplode("v").alias("j", "v")).groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    rows = cells.groupBy("d", "i").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("row"))
    found: dict[int, dict] = {}
    for r in rows.collect():
        found.setdefault(r["d"], {})[r["i"]] = [c["v"] for c in r["row"]]
    return {d: np.array([m[i] for i in range(len(m))]) for d, m in found.items()}


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L (d x rank, rows in the order of ``a``) with L Lt = a up to rounding."""
    d = len(a)
    left, columns = np.diag(a).astype(np.float64).copy(), np.zeros((d, d))
    stop = d * np.finfo(np.float64).eps * left.max(initial=0.0)
    for k in range(d):
        p = int(np.argmax(left))
        if not left[p] > stop:
            return columns[:, :k]
        column = a[:, p] - columns[:, :k] @ columns[p, :k]
        column[p] = left[p]
        columns[:, k] = column / np.sqrt(left[p])
        done = left <= -np.inf
        columns[done, k] = 0
        left -= columns[:, k] ** 2
        left[p] = -np.inf
    return columns


def rounds_of(r: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of r columns in rounds of disjoint pairs."""
    m, out = r + r % 2, []
    ring = list(range(m))
    for _ in range(m - 1):
        pairs = [(ring[i], ring[m - 1 - i]) for i in range(m // 2)]
        pairs = [(min(p), max(p)) for p in pairs if max(p) < r]
        out.append((np.array([p for p, _ in pairs]), np.array([q for _, q in pairs])))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(left: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms (falling) and unit columns of ``left`` after its columns
    have been rotated until each pair is orthogonal to working precision."""
    w = left.copy()
    pairs, eps = rounds_of(w.shape[1]) if w.shape[1] > 1 else [], np.finfo(np.float64).eps
    for _ in range(sweeps):
        worst = 0.0
        for p, q in pairs:
            a, b = w[:, p], w[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            off = np.abs(ab) / np.sqrt(np.maximum(aa * bb, np.finfo(np.float64).tiny))
            worst = max(worst, float(off.max(initial=0.0)))
            turn = off > eps
            zeta = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            w[:, p], w[:, q] = c * a - s * b, s * a + c * b
        if worst <= 4 * eps:
            break
    size = (w * w).sum(0)
    order = np.argsort(-size, kind="stable")
    return size[order], w[:, order] / np.sqrt(size[order])


def components(scatter: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit components (d x k), their eigenvalues and shares of the trace."""
    size, unit = one_sided_jacobi(pivoted_cholesky(scatter))
    k = int((size > TINY * size.max(initial=0.0)).sum()) if len(size) else 0
    k = min(k, most)
    return unit[:, :k], size[:k] / n, size[:k] / np.trace(scatter) if k else size[:0]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2 of every row, None beyond a long."""
    d = x.shape[1]
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s - n * int(w) for s, w in zip(sums, whole, strict=True)]
    away = x - whole
    most = max(int(np.abs(away).max(initial=0)), 1)
    if d * (n * (most + 1)) ** 2 < 1 << 63:
        return ((n * away - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * v - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in away.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whitened(models):
    def run(batches):
        for d, x, (ids,) in matrices(batches, "vec_id"):
            if d not in models.value or not len(models.value[d][4]):
                continue
            n, sums, whole, part, e, unit, share, error = models.value[d]
            k = len(e)
            w = centred(x, whole, part) @ unit / np.sqrt(e)
            rows = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(k * len(x), n, np.int64)),
                    pa.array(deviations(x, n, sums), pa.int64()).take(rows), pa.array(w.reshape(-1)), pa.array(np.tile(share, len(x))), pa.array(np.full(k * len(x), error)),
                ],
                [c.split()[0] for c in _OUT.split(", ")],
            )

    return run


def fit(x: DataFrame, most: int = COMPONENTS) -> dict[int, tuple]:
    """Length -> n, S, mean in two parts, eigenvalues, components, shares and the
    identity error of the distinct vectors of ``x`` (x array<long>)."""
    once = stored(x.select("x").distinct(), "whitening-fit")
    known = {d: (n, sums, *means(n, sums)) for d, (n, sums) in moments(once).items()}
    # tasks get plain arrays, so executors need nothing but numpy
    mean = once.sparkSession.sparkContext.broadcast({d: k[2:] for d, k in known.items()})
    scatter = products(once, lambda d, v: centred(v, *mean.value[d]) if d in mean.value else None)
    found = {d: components(scatter[d], known[d][0], most) for d in known}
    turn = once.sparkSession.sparkContext.broadcast({d: (*known[d][2:], unit / np.sqrt(e)) for d, (unit, e, _) in found.items() if len(e)})
    white = products(once, lambda d, v: centred(v, *turn.value[d][:2]) @ turn.value[d][2] if d in turn.value else None)
    return {d: (*known[d], e, unit, share, float(np.abs(white[d] / known[d][0] - np.eye(len(e))).max()) if len(e) else 0.0) for d, (unit, e, share) in found.items()}


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """One row for every usable row of ``vectors`` (vec_id, embedding) and component."""
    x = integers(vectors, F.col("vec_id").cast("long").alias("vec_id"))
    models = vectors.sparkSession.sparkContext.broadcast(fit(x, most))
    return x.mapInArrow(_whitened(models), _OUT)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
