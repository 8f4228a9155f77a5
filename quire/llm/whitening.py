"""Embedding whitening by a matrix-free block Jacobi-Davidson method.

Each entry c of a vector becomes the integer x = floor(1024 * c) + 100000. The
covariance V of the x-vectors (divisor n, centred before multiplying) is never
formed: V is only applied to a block of directions P, as one distributed pass
that sums (x - mean) * ((x - mean) . P) over blocks of vectors. The driver holds
the search space: at most ``BASIS`` vectors of the embedding's width.

1. Rayleigh-Ritz on the search space gives the leading Ritz pairs and their
   residuals; from the first pair on, those whose residual has reached double
   precision (``PRECISION`` times the largest value) are locked.
2. For each other one the projected correction equation
   (I - QQ')(V - theta I)(I - QQ') t = -residual, where Q holds the locked
   vectors and the pair's own, is solved by a few MINRES steps. All equations
   step together, so a step is one distributed product of the whole block.
3. The corrections join the search space (shrunk to its best Ritz vectors when
   it is full), until ``components`` pairs are locked. A last Rayleigh-Ritz over
   fresh products of the locked vectors gives values and residuals.

``guard`` Ritz pairs beyond the wanted ones ride along in the block, so that
close values behind the last one do not slow it down.

Defined results: vectors that are NULL or hold NULL or non-finite entries take
no part; neither do empty vectors, nor vectors of another length than the most
frequent one (ties: the longer). Repeated rows count as often as they occur and
each gets its rows; a NULL id rides along. Components of (numerically) zero
variance cannot be whitened and give no rows, so a table whose vectors are all
equal, like an empty one, gives none. Equal eigenvalues: any orthonormal basis.
Other columns ride along in ``row``. ``deviation`` is exact; beyond a long it is
NULL. Entries beyond 2^52 / 1024 are clipped to that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import materialise, packed

SCALE, SHIFT, LARGEST = 1024.0, 100_000, float(1 << 52)
COMPONENTS, GUARD = 8, 4
BASIS = 48        # the search space is shrunk beyond this many vectors
INNER = 6         # MINRES steps for a correction at most
OUTER = 100       # rounds of corrections at most; beyond that an error
INNER_SHARE = 0.05  # ... or until its residual has fallen to this share
PRECISION = 1e-14  # residuals are at most this share of the largest value
LEAST_SHARE = 1e-13  # of the trace: values below it are rounding
BLOCK_ROWS = 4096
TASK_BYTES = 64 << 20  # of the integer table that one task of a product reads
WHITENED = T.StructType([T.StructField("deviation", T.LongType()),
                         T.StructField("whitened", T.ArrayType(T.DoubleType()))])


def usable(vector: Column) -> Column:
    wrong = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(wrong, F.lit(True)) & (F.size(vector) > 0)


def integers(vectors) -> np.ndarray:
    """(rows, width) of x - SHIFT; numbers that a double holds exactly."""
    c = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return np.clip(np.floor(SCALE * c), -LARGEST, LARGEST)


@dataclass
class Centred:
    """Vectors as blocks of integers, with what every pass needs of them."""
    blocks: DataFrame   # (data binary, kind)
    n: int
    width: int
    sums: list[int]     # per dimension, of x - SHIFT

    @property
    def mean(self) -> np.ndarray:
        # quotient and rest apart: the quotient of two large integers is rounded once
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    def total(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum of ``of(centred block)``, an array, over all blocks: each
        task adds up its own, the rest is a grouped aggregate."""
        width, mean = self.width, self.mean

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for pdf in batches:
                for data, kind in zip(pdf["data"], pdf["kind"]):
                    x = np.frombuffer(data, kind).reshape(-1, width).astype(np.float64) - mean
                    part = np.asarray(of(x), dtype=np.float64)
                    total = part if total is None else total + part
            flat = np.zeros(0) if total is None else total.ravel()
            yield pd.DataFrame({"at": np.arange(flat.size, dtype=np.int64), "x": flat})

        got = (self.blocks.mapInPandas(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect())
        out = np.zeros(len(got))  # as many numbers as the array has
        for r in got:
            out[r["at"]] = r["x"]
        return out

    def product(self, p: np.ndarray) -> np.ndarray:
        """V P, without V."""
        if not p.shape[1]:
            return np.zeros_like(p)
        p = np.ascontiguousarray(p)
        return self.total(lambda x: x.T @ (x @ p)).reshape(p.shape) / self.n


def centred(df: DataFrame, vector_col: str = "embedding") -> Centred | None:
    """The table as blocks in the shared folder; None without any vector."""
    found = df.select(F.col(f"`{vector_col}`").alias("v")).where(usable(F.col("v")))
    widths = found.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not widths:
        return None
    width, n = widths[0]["width"], widths[0]["count"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), BLOCK_ROWS):
                x = integers(pdf["v"].iloc[at:at + BLOCK_ROWS])
                kind = "<i4" if np.abs(x).max() < 1 << 31 else "<i8"
                # sums of a block stay below 2^64: halves of 2^26 apart
                high, low = np.floor_divide(x, float(1 << 26)), np.mod(x, float(1 << 26))
                sums = [(int(h) << 26) + int(s) for h, s in zip(high.sum(axis=0), low.sum(axis=0))]
                yield pd.DataFrame({"data": [x.astype(kind).tobytes()], "kind": [kind],
                                    "sums": [[Decimal(s) for s in sums]]})

    chosen = found.where(F.size("v") == width)
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, n * width * 4 // TASK_BYTES + 1)
    blocks = materialise(chosen.mapInPandas(run, "data binary, kind string, sums array<decimal(38,0)>").coalesce(tasks))
    added = (blocks.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s")).collect())
    sums = [0] * width
    for r in added:
        sums[r["at"]] = int(r["s"])
    return Centred(blocks.select("data", "kind"), n, width, sums)


# ------------------------------------------------------------- the eigensolver

def _orthonormal(new: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Columns of ``new`` made orthonormal, also to the others; columns that
    hold nothing else go."""
    kept: list[np.ndarray] = []
    for t in new.T:
        size = np.linalg.norm(t)
        if not size:
            continue
        t = t / size
        for _ in range(2):  # twice is enough
            for q in others:
                t = t - q @ (q.T @ t)
            for q in kept:
                t = t - q * (q @ t)
        if (size := np.linalg.norm(t)) > 1e-8:
            t = t / size
            for q in others:
                t = t - q @ (q.T @ t)
            kept.append(t / np.linalg.norm(t))
    return np.array(kept).T if kept else np.zeros((new.shape[0], 0))


def _corrections(product, theta: np.ndarray, ritz: np.ndarray, residual: np.ndarray, locked: np.ndarray,
                 steps: int, share: float) -> np.ndarray:
    """MINRES on the projected correction equations, all columns together; a
    column stops when its residual has fallen to ``share`` of the first one."""
    def project(y, u):
        for _ in range(2):
            y = y - locked @ (locked.T @ y)
            y = y - u * (u * y).sum(axis=0)
        return y

    v = project(-residual, ritz)
    first = np.linalg.norm(v, axis=0)
    live = np.flatnonzero(first > 0)
    out = np.zeros_like(ritz)
    v = v[:, live] / first[live]
    u, th = ritz[:, live], theta[live]
    x, zero = np.zeros_like(v), np.zeros_like(v)
    v_old, w, w_old, beta, eta = zero, zero, zero, np.zeros(len(live)), first[live].copy()
    cos, cos_old, sin, sin_old = np.ones(len(live)), np.ones(len(live)), np.zeros(len(live)), np.zeros(len(live))
    for _ in range(steps):
        if not len(live):
            break
        av = project(product(v) - v * th, u)
        alpha = (v * av).sum(axis=0)
        av = av - v * alpha - v_old * beta
        after = np.linalg.norm(av, axis=0)
        delta = cos * alpha - cos_old * sin * beta
        r1 = np.hypot(delta, after)
        r2 = sin * alpha + cos_old * cos * beta
        r3 = sin_old * beta
        r1 = np.where(r1 > 0, r1, 1.0)
        w, w_old = (v - w_old * r3 - w * r2) / r1, w
        cos_old, cos, sin_old, sin = cos, delta / r1, sin, after / r1
        x = x + w * (cos * eta)
        eta = -sin * eta
        v_old, v, beta = v, av / np.where(after > 0, after, 1.0), after
        out[:, live] = x
        go = (np.abs(eta) > share * first[live]) & (after > 1e-15 * np.abs(th))
        live, u, th, x, v, v_old, w, w_old = live[go], u[:, go], th[go], x[:, go], v[:, go], v_old[:, go], w[:, go], w_old[:, go]
        beta, eta, cos, cos_old, sin, sin_old = beta[go], eta[go], cos[go], cos_old[go], sin[go], sin_old[go]
    return out


def leading(product: Callable[[np.ndarray], np.ndarray], width: int, components: int = COMPONENTS,
            guard: int = GUARD, precision: float = PRECISION) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors as columns, residual norms as shares of the largest
    value) of the leading eigenpairs of a symmetric positive semidefinite
    operator, by falling value."""
    wanted, block = min(components, width), min(width, components + guard)
    noise = np.random.default_rng(13)
    space = _orthonormal(noise.standard_normal((width, min(width, 2 * block))))
    image = product(space)
    locked, scale, best, stalled = np.zeros((width, 0)), 0.0, np.inf, 0
    for _ in range(OUTER):
        theta, s = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        space, image, scale = space @ s, image @ s, max(scale, theta[0])
        if scale <= 0:
            return np.zeros(0), np.zeros((width, 0)), np.zeros(0)
        take = min(block - locked.shape[1], space.shape[1])
        residual = image[:, :take] - space[:, :take] * theta[:take]
        residual = residual - locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0) / scale
        # rounding of the sums may stop a residual a little above the aim
        stalled = 0 if size[0] < best / 2 else stalled + 1
        best = min(best, size[0])
        near = precision if stalled < 3 else 100 * precision
        done = 0
        while done < take and locked.shape[1] + done < wanted and size[done] <= near:
            done += 1
        if done:
            locked = np.hstack([locked, space[:, :done]])
            space, image, theta, residual = space[:, done:], image[:, done:], theta[done:], residual[:, done:]
            best, stalled, take, size = np.inf, 0, take - done, size[done:]
        if locked.shape[1] == wanted or not take:
            break
        if space.shape[1] + take > max(BASIS, 3 * block):
            space, image = space[:, :2 * block], image[:, :2 * block]
        open_ = np.flatnonzero(size > precision)
        new = _orthonormal(_corrections(product, theta[open_], space[:, open_], residual[:, open_], locked, INNER,
                                        INNER_SHARE), locked, space)
        if not new.shape[1]:  # nothing to add: try other directions, unless the space is whole
            new = _orthonormal(noise.standard_normal((width, block)), locked, space)
        if new.shape[1]:
            space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    else:
        raise ArithmeticError(f"{locked.shape[1]} of {wanted} components after {OUTER} rounds")
    locked = _orthonormal(locked)
    image = product(locked)
    theta, s = np.linalg.eigh((locked.T @ image + image.T @ locked) / 2)
    vectors, image = locked @ s[:, ::-1], image @ s[:, ::-1]
    theta = theta[::-1]
    return theta, vectors, np.linalg.norm(image - vectors * theta, axis=0) / scale


# ------------------------------------------------------------------ the operator

@dataclass
class Whitening:
    n: int
    width: int
    sums: list[int]            # of x, per dimension
    mean: np.ndarray           # of x - SHIFT
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float
    identity_error: float

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """None without any usable vector."""
    table = centred(df, vector_col)
    if table is None:
        return None
    trace = float(table.total(lambda x: np.array([(x * x).sum()]))[0]) / table.n
    values, vectors, residuals = leading(table.product, table.width, components) if trace > 0 else \
        (np.zeros(0), np.zeros((table.width, 0)), np.zeros(0))
    keep = values > LEAST_SHARE * trace
    values, vectors, residuals = values[keep], vectors[:, keep], residuals[keep]
    error = 0.0
    if len(values):
        p = vectors / np.sqrt(values)
        k = len(values)
        middle = table.total(lambda x: (x @ p).sum(axis=0)) / table.n

        def spread(x):
            y = x @ p - middle
            return y.T @ y
        error = float(np.abs(table.total(spread).reshape(k, k) / table.n - np.eye(k)).max())
    return Whitening(table.n, table.width, [s + SHIFT * table.n for s in table.sums], table.mean, values, vectors,
                     residuals, trace, error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - sum)^2, in integers; x and sums
    without the shift, which cancels."""
    far = max(abs(int(x.max())), abs(int(x.min()))) * n + max(map(abs, sums))
    if far * far * len(sums) < 1 << 63:
        d = x.astype(np.int64) * n - np.array(sums, dtype=np.int64)
        return (d * d).sum(axis=1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return [e if e < 1 << 63 else None for e in exact]


def annotate(df: DataFrame, model: Whitening, vector_col: str = "embedding") -> DataFrame:
    """(row, deviation, whitened array<double>) of every usable vector."""
    n, sums, mean, p = model.n, [s - SHIFT * model.n for s in model.sums], model.mean, model.projection

    @F.pandas_udf(WHITENED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            if len(vectors):
                x = integers(vectors)
                yield pd.DataFrame({"deviation": pd.array(_deviations(x, n, sums), dtype="Int64"),
                                    "whitened": list((x - mean) @ p)})
            else:
                yield pd.DataFrame({"deviation": pd.array([], dtype="Int64"), "whitened": []})

    vector = F.col("row")[vector_col]
    return (packed(df).where(usable(vector) & (F.size(vector) == model.width))
            .withColumn("own", run(vector)).select("row", "own.*"))


def whiten(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(row, component from 1, n, deviation, whitened, explained, identity_error, residual),
    one row per usable vector and component."""
    model = fit(df, vector_col, components)
    if model is None:
        model = Whitening(0, 0, [], np.zeros(0), np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)

    def of(numbers) -> Column:
        return F.array(*[F.lit(float(v)) for v in numbers]).cast("array<double>")[F.col("at")]

    return (annotate(df, model, vector_col)
            .select("row", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("row", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    "whitened", of(model.values / model.trace if len(model.values) else []).alias("explained"),
                    F.lit(model.identity_error).alias("identity_error"), of(model.residuals).alias("residual")))
