"""Moment matrices: everything a linear model needs to know about the rows.

For z = [1, columns...] the matrix sum(z z') per key gives means, least squares, ridge,
elastic net, R2 and fold errors without a second look at the rows. Its size depends on
the number of columns only. Each task adds up its own rows first, so a key that holds
most of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import col, complete_rows, finite, value
from ..session import runs_in_tasks

# Above this many products the matrix is added up in numpy instead of by one SQL
# aggregate per product.
BUILTIN_PRODUCTS = 100
# Columns a driver-side solver may face; wider problems belong to iterative solvers.
WIDEST = 2000
# Doubles a task holds before it hands its partial matrices on.
HELD_DOUBLES = 4_000_000


def gram(df: DataFrame, columns: Sequence[Column], keys: Sequence[str] = (),
         shift: Sequence[float] | None = None,
         expand: tuple[int, Callable[[np.ndarray], np.ndarray]] | None = None) -> DataFrame:
    """One row per key: the keys and ``gram``, the upper triangle of sum(z z') by rows.

    Rows with a missing value (NULL, NaN or infinite) in any column or key are left out. ``shift`` is subtracted from
    the columns first, which keeps digits when a mean is far larger than its spread.
    ``expand`` is (width, function): a block of rows is turned into ``width`` columns
    before it is multiplied, so that wide derived features never become table columns.
    """
    width = expand[0] if expand else len(columns)
    if width > WIDEST:
        raise ValueError(f"{width} columns; moment matrices are kept to {WIDEST}")
    shift = list(shift) if shift is not None else [0.0] * len(columns)
    z = [finite(c.cast("double") - F.lit(float(s)) if s else c.cast("double")) for c, s in zip(columns, shift)]
    narrow = complete_rows(df, keys).select(*[col(k) for k in keys], *[c.alias(f"_z{i}") for i, c in enumerate(z)])
    names = [f"_z{i}" for i in range(len(z))]
    m = len(z) + 1
    if not expand and m * (m + 1) // 2 <= BUILTIN_PRODUCTS:
        narrow = complete_rows(narrow, names)
        each = ["1D", *names]
        sums = [f"sum({each[i]} * {each[j]})" for i in range(m) for j in range(i, m)]
        return narrow.groupBy(*[col(k) for k in keys]).agg(F.expr(f"array({', '.join(sums)})").alias("gram"))
    return _numpy_gram(narrow, names, keys, expand)


def _numpy_gram(narrow: DataFrame, names: Sequence[str], keys: Sequence[str], expand=None) -> DataFrame:
    keys, held, read = list(keys), HELD_DOUBLES, len(names)
    width, change = expand if expand else (read, None)
    rows = narrow.select(*[col(k) for k in keys], F.array(*[F.col(n) for n in names]).alias("z"))
    key_fields = [narrow.schema[k] for k in keys]
    schema = T.StructType([*key_fields, T.StructField("gram", T.ArrayType(T.DoubleType()))])

    def partial(batches):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        upper = np.triu_indices(width + 1)
        sums: dict = {}

        def flush():
            values = [s[upper] for s in sums.values()]
            arrays = [pa.array([k[i] for k in sums]) for i in range(len(keys))]
            flat = pa.array(np.concatenate(values))
            offsets = pa.array(np.arange(0, flat.__len__() + 1, len(upper[0]), dtype=np.int32))
            return pa.RecordBatch.from_arrays(
                [*arrays, pa.ListArray.from_arrays(offsets, flat)], names=[*keys, "gram"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, read)
            # a missing value arrives as NaN; dropping here spares a filter over every column
            complete = ~np.isnan(x).any(axis=1)
            x = x[complete]
            x = change(x) if change else x
            z = np.column_stack([np.ones(len(x)), x])
            if keys:
                frame = pd.DataFrame({k: batch.column(k).to_pandas() for k in keys})[complete]
                parts = frame.groupby(keys, dropna=False, sort=False).indices.items()
            else:
                parts = [((), slice(None))]
            for key, index in parts:
                key = key if isinstance(key, tuple) else (key,)
                part = z[index]
                product = part.T @ part
                if key in sums:
                    sums[key] += product
                else:
                    sums[key] = product
                if len(sums) * (width + 1) ** 2 > held:
                    yield flush()
                    sums.clear()
        if sums:
            yield flush()

    long = rows.mapInArrow(partial, schema).select(*[col(k) for k in keys], F.posexplode("gram"))
    added = long.groupBy(*[col(k) for k in keys], "pos").agg(F.sum("col").alias("v"))
    listed = added.groupBy(*[col(k) for k in keys]).agg(
        F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("e"))
    return listed.select(*[col(k) for k in keys], F.col("e.v").alias("gram"))


def square(flat) -> np.ndarray:
    """The full symmetric matrix from its upper triangle."""
    flat = np.asarray(flat, dtype=float)
    m = int((np.sqrt(8 * len(flat) + 1) - 1) / 2)
    full = np.zeros((m, m))
    full[np.triu_indices(m)] = flat
    return full + np.triu(full, 1).T


def collect_gram(df: DataFrame, columns: Sequence[Column], keys: Sequence[str] = (),
                 shift: Sequence[float] | None = None, expand=None) -> dict:
    """{key tuple: matrix} for keys known to be few, such as folds."""
    return {tuple(r[k] for k in keys): square(r["gram"])
            for r in gram(df, columns, keys, shift, expand).collect() if r["gram"][0] is not None}


def pairwise_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlations of all pairs of a wide table, each over the rows where both are
    present, from one matrix over [values, present flags, squares]."""
    from ..operators.distribution import ranges
    from ..session import small_frame

    means = [r.mean or 0.0 for r in ranges(df, columns)]
    x = [F.coalesce(value(c) - F.lit(m), F.lit(0.0)) for c, m in zip(columns, means)]
    present = [value(c).isNotNull().cast("double") for c in columns]
    g = collect_gram(df, [*x, *present, *[v * v for v in x]])[()]
    p = len(columns)
    values, flags, squares = (slice(1 + i * p, 1 + (i + 1) * p) for i in range(3))
    n, sx, sxx = g[flags, flags], g[values, flags], g[squares, flags]
    with np.errstate(invalid="ignore", divide="ignore"):
        cross = g[values, values] - sx * sx.T / n
        spread = sxx - sx * sx / n
        r = np.where((spread > 1e-12 * sxx) & (spread.T > 1e-12 * sxx.T), cross / np.sqrt(spread * spread.T), np.nan)
    rows = [(columns[i], columns[j], None if not np.isfinite(r[i, j]) else float(r[i, j]))
            for i in range(p) for j in range(i + 1, p)]
    return small_frame(df.sparkSession, rows, "a string, b string, r double")


runs_in_tasks(__name__)
