"""Linear models of any width: solvers that read the rows once a step and hold vectors, no matrices.

Rows lie in compressed blocks. A step sends one vector of the width to the tasks and adds up one vector
per task; columns are centered in the products, so blocks stay sparse. Least squares and ridge take
conjugate gradients (Hestenes and Stiefel 1952) preconditioned by the column spreads; elastic nets take
accelerated proximal steps (Beck and Teboulle 2009) with restarts (O'Donoghue and Candes 2015). Steps are measured in
column spreads, so no column needs scaling; their size falls whenever two gradients show more curvature than assumed.
"""

from __future__ import annotations

import contextlib
import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import finite
from ..session import arrow_batches, kept, runs_in_tasks
from ..stage import Fitted

# Doubles per row of a partial sum on its way to the adding tasks.
CHUNK = 8_192
# Chunks, or blocks of rows, in one Arrow batch.
RECORDS = 32
# Steps after which a solver gives up, with a warning.
MOST_STEPS = 2_000


def _compressed(batches, dense: bool):
    """Blocks of complete rows: targets, entries per row, places and values."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
        listed = batch.column("e")
        flat = listed.flatten()
        if dense:
            x = flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(y), -1)
            complete = np.isfinite(x).all(axis=1) & np.isfinite(y)
            x, y = x[complete], y[complete]
            row, at = np.nonzero(x)
            x = x[row, at]
        else:
            count = np.diff(listed.offsets.to_numpy())
            row = np.repeat(np.arange(len(y)), count)
            at = flat.field("at").to_numpy(zero_copy_only=False)
            x = flat.field("x").to_numpy(zero_copy_only=False).astype(float)
            complete = np.isfinite(y)
            complete[row[~np.isfinite(x)]] = False
            use = complete[row]
            row, at, x = (np.cumsum(complete) - 1)[row[use]], at[use], x[use]
            y = y[complete]
        if not len(y):
            continue
        parts = (y, row.astype(np.int32), at.astype(np.int32), x)
        yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["y", "row", "at", "x"])


class Problem:
    """Centered rows of one table, read in passes. Rows with a missing or infinite value are left out."""

    def __init__(self, blocks: DataFrame, width: int):
        self.blocks, self.width = blocks, width

        def first(y, row, at, x):
            places = at.astype(np.int64)
            return [(places, x), (places + width, x * x), (np.array([2 * width, 2 * width + 1]), np.array([len(y), y.sum()]))]

        total = self.add(first, 2 * width + 2)
        self.n = float(total[-2])
        if not self.n:
            raise ValueError("no complete rows to fit on")
        sums, squares = total[:width], total[width:2 * width]
        self.means, self.mean = sums / self.n, float(total[-1]) / self.n
        spread = squares - self.n * self.means ** 2
        # without spread but for rounding: a constant, whose slope is 0
        self.live = spread > 1e-12 * squares
        self.spread = np.where(self.live, spread, 0.0)
        self.size = float(self.add(lambda y, row, at, x, m=self.mean: [(np.zeros(1, int), ((y - m) ** 2).sum(keepdims=True))], 1)[0])

    def add(self, work, length: int) -> np.ndarray:
        """The sum over all blocks of what ``work`` lists as places and values, added up by chunks in tasks. A task holds one
        vector of ``length`` and few records at a time, which are as long as a chunk or a block."""
        def partial(batches):
            total = None
            for batch in batches:
                for i in range(batch.num_rows):
                    y, row, at, x = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in
                                     (("y", float), ("row", np.int32), ("at", np.int32), ("x", float)))
                    total = np.zeros(length) if total is None else total
                    for places, values in work(y, row, at, x):
                        np.add.at(total, places, values)
            if total is not None:
                yield from _chunks({c: total[c * CHUNK:(c + 1) * CHUNK] for c in range(-(-length // CHUNK))})

        def added(batches):
            held: dict = {}
            for batch in batches:
                for c, s in zip(batch.column("chunk").to_pylist(), batch.column("sums")):
                    part = np.frombuffer(s.as_buffer(), float)
                    if c in held:
                        held[c] += part
                    else:
                        held[c] = part.copy()
            yield from _chunks(held)

        schema, total = "chunk int, sums binary", np.zeros(length)
        with arrow_batches(self.blocks.sparkSession, RECORDS):
            rows = self.blocks.mapInArrow(partial, schema).repartition("chunk").mapInArrow(added, schema).collect()
        for r in rows:
            part = np.frombuffer(r["sums"], float)
            total[r["chunk"] * CHUNK:r["chunk"] * CHUNK + len(part)] = part
        return total

    def product(self, v: np.ndarray, less_target: bool = False) -> np.ndarray:
        """X'(X v), or X'(X v - y), of centered columns and target."""
        context = self.blocks.sparkSession.sparkContext
        sent, width = context.broadcast(v), self.width
        shift = float(self.means @ v) - (self.mean if less_target else 0.0)

        def step(y, row, at, x):
            r = np.bincount(row, x * sent.value[at], len(y)) - shift
            if less_target:
                r = r - y
            return [(at, x * r[row]), (np.array([width]), r.sum(keepdims=True))]

        try:
            total = self.add(step, width + 1)
        finally:
            sent.destroy()
        return np.where(self.live, total[:-1] - self.means * total[-1], 0.0)

    def with_intercept(self, b: np.ndarray):
        return self.mean - float(self.means @ b), b


def _chunks(held: dict):
    import pyarrow as pa

    some = [c for c, v in held.items() if v.any()]
    for k in range(0, len(some), RECORDS):
        few = some[k:k + RECORDS]
        yield pa.RecordBatch.from_arrays([pa.array(few, pa.int32()), pa.array([held[c].tobytes() for c in few], pa.binary())],
                                         names=["chunk", "sums"])


@contextlib.contextmanager
def problem(df: DataFrame, entries: str | Sequence[Column], target: Column, width: int) -> Iterator[Problem]:
    """Blocks of ``df`` for as long as the solver needs them. ``entries`` names a column of entries, or lists
    the columns of a dense table."""
    dense = not isinstance(entries, str)
    features = F.array(*[finite(c.cast("double")) for c in entries]) if dense else F.col(entries)
    rows = df.select(finite(target.cast("double")).alias("y"), features.alias("e")).where(
        "y is not null and e is not null")
    blocks = rows.mapInArrow(lambda batches: _compressed(batches, dense), "y binary, row binary, at binary, x binary")
    with kept(blocks) as held:
        yield Problem(held, width)


def _unfinished(what: str, steps: int) -> None:
    warnings.warn(f"{what} did not converge in {steps} steps; the last solution is returned", stacklevel=3)


def ridge(p: Problem, alpha: float = 0.0, tolerance: float = 1e-10, most: int = MOST_STEPS):
    """Least squares with alpha * |b|^2 added to the sum of squares. Of several least-squares solutions it finds
    the shortest, with slopes measured in spreads. Stops when the scaled gradient is below ``tolerance`` of the target's spread."""
    b, r = np.zeros(p.width), -p.product(np.zeros(p.width), True)
    scale = np.where(p.live, p.spread + alpha, 1.0)
    z = r / scale
    d, rz = z.copy(), float(r @ z)
    for _ in range(most):
        if rz <= tolerance ** 2 * p.size:
            break
        q = p.product(d) + alpha * d
        step = rz / float(d @ q)
        b, r = b + step * d, r - step * q
        z = r / scale
        old, rz = rz, float(r @ z)
        d = z + rz / old * d
    else:
        _unfinished("ridge", most)
    return p.with_intercept(b)


def elastic_net(p: Problem, alpha: float, l1_ratio: float, start=None, tolerance: float = 1e-7, most: int = MOST_STEPS):
    """Minimizes mean squared error / 2 + alpha * (l1_ratio |b|_1 + (1 - l1_ratio) |b|^2 / 2). Stops when a step moves no
    slope by more than ``tolerance`` of the target's spread, in units of its step size. ``start`` may be slopes of
    a near penalty."""
    if alpha * l1_ratio == 0:
        return ridge(p, alpha * p.n, tolerance, most)
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    unit, most_curved = np.where(p.live, p.spread / p.n, 1.0), 1.0
    limit = tolerance * np.sqrt(p.size / p.n)
    b = np.zeros(p.width) if start is None else np.array(start, dtype=float)
    v, t, before = b, 1.0, None
    for _ in range(most):
        slope = p.product(v, True) / p.n
        if before is not None and (moved := float(((v - before[0]) ** 2) @ unit)) > 0:
            seen = float((v - before[0]) @ (slope - before[1])) / moved
            if seen > most_curved:
                most_curved, t, b = 1.2 * seen, 1.0, v
        before, curve = (v, slope), most_curved * unit
        u = curve * v - slope
        new = np.where(p.live, np.sign(u) * np.maximum(np.abs(u) - l1, 0.0) / (curve + l2), 0.0)
        # weighted so that columns of any unit count alike
        if np.max(np.abs(new - v) * np.sqrt(unit), initial=0.0) * most_curved <= limit:
            b = new
            break
        if float(((v - new) * curve) @ (new - b)) > 0:  # momentum points uphill
            t = 1.0
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, b, t = new + (t - 1) / faster * (new - b), new, faster
    else:
        _unfinished("elastic net", most)
    return p.with_intercept(b)


class SparseFit(Fitted):
    """Intercept and slopes by place; predicts from a column of entries, NULL where that is NULL."""

    def __init__(self, entries=None, intercept=0.0, slopes=(), prediction="prediction"):
        super().__init__(**({"entries": entries, "intercept": float(intercept), "slopes": [float(b) for b in slopes],
                             "prediction": prediction} if entries else {}))

    @property
    def intercept(self) -> float:
        return self["intercept"]

    @property
    def slopes(self) -> np.ndarray:
        return np.asarray(self["slopes"])

    def _transform(self, df: DataFrame) -> DataFrame:
        slopes, intercept = self.slopes, self.intercept

        def predict(at: pd.Series, x: pd.Series) -> pd.Series:
            row = np.repeat(np.arange(len(at)), at.map(len).to_numpy(dtype=int))
            parts = slopes[np.concatenate(at.to_numpy())] * np.concatenate(x.to_numpy()) if len(row) else np.zeros(0)
            return pd.Series(np.bincount(row, parts, len(at)) + intercept)

        e = F.coalesce(F.col(self["entries"]), F.array().cast("array<struct<at:int,x:double>>"))
        found = F.pandas_udf(predict, "double")(F.transform(e, lambda s: s["at"]), F.transform(e, lambda s: s["x"]))
        return df.withColumn(self["prediction"], F.when(F.col(self["entries"]).isNotNull(), found))


runs_in_tasks(__name__)
