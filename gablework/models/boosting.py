"""Boosted trees by keyed histograms: Huber loss, best-first growth with L1 and L2, dropped trees.

The table is cut into bins once and written as blocks of small integers. Each level of a tree is one pass: tasks add up
gradients by node, feature and bin, Spark adds the cells of all tasks by key, and the driver, which sees cells
only, picks the cuts. A block keeps what the trees of some time ago leave of the target; every pass brings it up to date by
the trees grown, dropped or reweighted since, and after REFRESH trees the blocks are written anew. Where several trees share
a sample of the rows, the sample is written too, without the marks that drew it, and their passes read it alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col, complete_rows, missing_if_nan
from ..session import arrow_batches, delete_path, fresh_path, runs_in_tasks
from ..stage import Fitted, unique

#: Rows of a block, and trees after which blocks are written anew.
BLOCK_ROWS, REFRESH = 1 << 16, 10
#: Numbers that a task of a pass reads: a small table is one task, which needs no shuffle.
TASK_CELLS = 1 << 21
#: Values that tasks send for quantiles, all tasks and leaves of a pass together. A task with more of them for one quantile than
#: its part sends so many equal groups, by their least and greatest values, and another pass reads the values still in question.
EXACT, GROUPS = 1 << 20, 1 << 11
#: Cuts of a tree up to which a block goes through them one by one.
FEW_CUTS = 32
MARK = "_mark"
BLOCK = "rows int, bins binary, y binary, mark binary"


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Where each feature is cut: between its values if there are at most ``bins``, else at its quantiles."""
    if not features:
        return []
    n = df.agg(*(F.approx_count_distinct(col(c)).alias(str(i)) for i, c in enumerate(features))).first()
    few = [i for i in range(len(features)) if n[i] <= 0.9 * bins]
    grid = [j / bins for j in range(1, bins)]
    found = df.agg(*((F.collect_set(col(c)) if i in few else F.percentile_approx(col(c), grid, 50 * bins)).alias(str(i))
                     for i, c in enumerate(features))).first()
    edges = []
    for i in range(len(features)):
        values = sorted(set(found[i] or []))
        if i in few:  # a sum of halves can't overflow
            values = [a / 2 + b / 2 for a, b in zip(values, values[1:])]
        edges.append(values[:bins - 1])
    return edges


def spread(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def drawn(marks: np.ndarray, seed: int, turn: int, share: float) -> np.ndarray:
    """Which rows, by their marks, belong to the sample of a turn."""
    if share >= 1:
        return np.ones(len(marks), bool)
    key = spread(np.array([seed * 1_000_003 + turn], np.uint64))
    return (spread(marks ^ key) >> np.uint64(11)).astype(np.float64) / 2 ** 53 < share


def chosen(features: int, wanted: float | str, seed: int, *turn: int) -> np.ndarray:
    """The features that a tree or node may use: a share of them, or "sqrt" or "log2" of their number, at least one."""
    n = {"sqrt": math.sqrt(features), "log2": math.log2(features)}[wanted] if isinstance(wanted, str) else wanted * features
    n = min(features, max(1, int(n)))
    order = np.random.default_rng([seed, *turn]).permutation(features) if n < features else np.arange(features)
    return np.sort(order[:n])


def between(sent: Sequence, q: float) -> float | tuple[float, float] | None:
    """The quantile ``q`` of values known by groups: interpolated if the values of both ranks beside it are known, else what
    they lie between; nothing of no values. A rank's value is no less than the same rank of the groups' least values, each
    counted as often as its group has values, and no more than that of the greatest."""
    least, greatest, n = (np.concatenate([np.zeros(0, kind), *(np.frombuffer(r[name], kind) for r in sent)])
                          for name, kind in (("least", np.float64), ("greatest", np.float64), ("n", np.int64)))
    if not n.sum():
        return None
    place = q * float(n.sum() - 1)
    ranks = math.floor(place), math.ceil(place)

    def ranked(x):
        order = np.argsort(x, kind="stable")
        return x[order][np.searchsorted(n[order].cumsum(), ranks, side="right")].tolist()

    (a, b), (c, d) = ranked(least), ranked(greatest)
    if (a, b) != (c, d):
        return a, d
    return a if a == b else (ranks[1] - place) * a + (place - ranks[0]) * b


class Grown:
    """A tree: for each node its feature, cut (a bin), first child (the second follows; 0 for a leaf) and value."""

    def __init__(self):
        self.feature, self.cut, self.child, self.value = [0], [0], [0], [0.0]

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.cut[node], self.child[node] = int(feature), int(cut), left
        for column, start in ((self.feature, 0), (self.cut, 0), (self.child, 0), (self.value, 0.0)):
            column += [start, start]
        return left, left + 1

    def leaves(self) -> list[int]:
        return [i for i, child in enumerate(self.child) if not child]


def node_of(table: np.ndarray, feature: Sequence[int], cut: Sequence[float], child: Sequence[int]) -> np.ndarray:
    """The leaf that each row of ``table`` falls to: to the first child where it is no more than the cut."""
    feature, cut, child = np.asarray(feature), np.asarray(cut), np.asarray(child)
    node, rows = np.zeros(len(table), np.int64), np.arange(len(table))
    while len(rows):
        rows = rows[child[node[rows]] > 0]
        at = node[rows]
        node[rows] = child[at] + (table[rows, feature[at]] > cut[at])
    return node


def leaf_of(bins: np.ndarray, feature: Sequence[int], cut: Sequence[int], child: Sequence[int]) -> np.ndarray:
    """``node_of`` for a block, which holds its bins feature by feature: a small tree is gone through cut by cut, each a few
    operations on whole columns, which takes a small part of the time of looking up every row's next cut."""
    if sum(c > 0 for c in child) > FEW_CUTS:
        return node_of(bins.T, feature, cut, child)
    node = np.zeros(bins.shape[1], np.int16)
    for at, first in enumerate(child):  # children come after their parents
        if first:
            node += (node == at) * (np.int16(first - at) + (bins[feature[at]] > cut[at]))
    return node


@dataclass(frozen=True)
class Boosting:
    """Gradient boosting by histograms.

    ``loss`` is "squared" or "huber"; Huber's transition is the ``quantile`` of the absolute residuals, anew for each
    tree, its first prediction the median, and a leaf's value its median residual plus the mean of what is left, clipped at
    the transition. ``leaves`` grows best leaf first up to that many leaves, ``depth`` bounds the levels; without ``leaves``
    whole levels grow. ``l1`` shrinks the gradient sums of squared loss towards zero, ``l2`` adds to the counts below them.
    ``rows`` is the share of rows of a tree, drawn anew every ``rows_every`` trees; ``columns`` the share of features (or "sqrt",
    "log2") of each tree or, by ``columns_by="node"``, each node. ``drop`` leaves each earlier tree out of a round with these odds, at
    least one and at most ``most_dropped``, but in a share ``skip_drop`` of the rounds; the new tree then counts 1 / (k + 1) beside
    k dropped ones, which keep k / (k + 1) of their weight. ``leaf`` is the least number of rows of a leaf.
    """

    n_trees: int = 100
    rate: float = 0.1
    depth: int | None = 3
    leaves: int | None = None
    leaf: int = 1
    loss: str = "squared"
    quantile: float = 0.9
    l1: float = 0.0
    l2: float = 0.0
    rows: float = 1.0
    rows_every: int = 1
    columns: float | str = 1.0
    columns_by: str = "tree"
    drop: float = 0.0
    skip_drop: float = 0.5
    most_dropped: int = 50
    bins: int = 64
    seed: int = 6

    def __post_init__(self):
        if self.loss not in ("squared", "huber"):
            raise ValueError(f"unknown loss {self.loss}")
        if not 2 <= self.bins <= 256:
            raise ValueError("bins are 2 to 256")
        if self.depth is None and self.leaves is None:
            raise ValueError("name a depth, a number of leaves or both")

    def fit(self, df: DataFrame, features: Sequence[str], target: str, prediction: str = "prediction",
            key: str | None = None) -> BoostedFit:
        """Rows with a missing feature or target are left out; in prediction they give NULL. Rows are drawn by ``key``, or
        by their values and place."""
        names = unique(features, "feature")
        columns = list(dict.fromkeys([*names, target]))
        numbers = [col(c).cast("double").alias(c) for c in dict.fromkeys([*names, target])]
        drawn_by = F.xxhash64(*(col(c) for c in ([key] if key else columns))).alias(MARK)
        rows = complete_rows(df.select(*numbers, drawn_by), list(dict.fromkeys([*names, target])))
        with arrow_batches(df.sparkSession, 10_000):
            edges = bin_edges(rows, names, self.bins)
            work = _Training(self, rows, names, target, key is not None, edges)
        with arrow_batches(df.sparkSession, 4), work:
            trees, weights = work.run()
        grown = [{"feature": t.feature, "cut": [float(edges[f][c]) if k else 0.0 for f, c, k in zip(t.feature, t.cut, t.child)],
                  "child": t.child, "value": [float(v * w) for v in t.value]} for t, w in zip(trees, weights)]
        return BoostedFit(names, work.start, grown, prediction)

    def best_cut(self, g: np.ndarray, n: np.ndarray, allowed: np.ndarray) -> tuple[float, int, int] | None:
        """gain, feature and bin of the best cut of a node with the gradient sums ``g`` and counts ``n`` by feature and bin."""
        left_g, left_n = g.cumsum(axis=1)[:, :-1], n.cumsum(axis=1)[:, :-1]
        all_g, all_n = g.sum(axis=1)[:, None], n.sum(axis=1)[:, None]
        before = self.strength(all_g, all_n)
        gain = self.strength(left_g, left_n) + self.strength(all_g - left_g, all_n - left_n) - before
        fits = (np.minimum(left_n, all_n - left_n) >= max(1, self.leaf)) & allowed[:, None]
        gain = np.where(fits, gain, -np.inf)
        if not gain.size:
            return None
        feature, cut = np.unravel_index(np.argmax(gain), gain.shape)
        best = float(gain[feature, cut])
        return (best, int(feature), int(cut)) if best > 1e-12 * max(1.0, float(before[feature, 0])) else None

    def shrunk(self, g):
        return np.sign(g) * np.maximum(np.abs(g) - self.l1, 0.0)

    def strength(self, g, n):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(n > 0, self.shrunk(g) ** 2 / (n + self.l2), 0.0)


class _Training:
    """The blocks of one fit and the passes over them."""

    def __init__(self, how: Boosting, rows: DataFrame, names: list[str], target: str, keyed: bool, edges: list):
        self.how, self.spark, self.names, self.edges = how, rows.sparkSession, names, edges
        self.width = max((len(e) for e in edges), default=0) + 1
        self.trees: list[Grown] = []
        self.weights = np.zeros(0)
        self.known = np.zeros(0)  # the weights of the trees that blocks have taken from their targets
        self.blocks: DataFrame | None = None
        self.sample: DataFrame | None = None  # blocks of the rows drawn for this turn, if they are written
        self.sample_known = np.zeros(0)
        self.paths: dict[str, str] = {}
        count = len(names)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                marks = batch.column(count + 1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                if not keyed:
                    marks = spread(marks + np.arange(len(marks), dtype=np.uint64))
                y = batch.column(count).to_numpy(zero_copy_only=False).astype(np.float64)
                table = np.empty((count, len(y)), np.uint8)
                for j in range(count):
                    table[j] = np.searchsorted(edges[j], batch.column(j).to_numpy(zero_copy_only=False), side="left")
                for k in range(0, len(y), BLOCK_ROWS):
                    some = slice(k, k + BLOCK_ROWS)
                    yield _block(table[:, some], y[some], marks[some])

        wide = rows.select(*(col(c).alias(f"x{i}") for i, c in enumerate(names)), col(target).alias("y"), col(MARK).alias("mark"))
        self._write("blocks", wide.mapInArrow(cut, BLOCK))
        total = self.blocks.agg(F.sum("rows")).first()[0] or 0
        self.tasks = max(1, -(-total * max(1, count) // TASK_CELLS))
        self.start = 0.0

    def __enter__(self) -> _Training:
        return self

    def __exit__(self, *_) -> None:
        self._drop("sample")
        self._drop("blocks")

    def _drop(self, name: str) -> None:
        if name in self.paths:
            getattr(self, name).unpersist()
            setattr(self, name, None)
            delete_path(self.spark, self.paths.pop(name))

    def _write(self, name: str, blocks: DataFrame) -> None:
        """Blocks as a table of the shared folder, so that passes read it and not what it came from."""
        path = fresh_path(self.spark, "boosting")
        blocks.write.parquet(path)
        self._drop(name)
        setattr(self, name, self.spark.read.schema(BLOCK).parquet(path).persist(StorageLevel.MEMORY_AND_DISK))
        self.paths[name] = path

    def _pass(self, weights: np.ndarray, schema: str, begin, add, end, whole: bool = False) -> DataFrame:
        """A pass over the blocks, or over the sample if it is written and the pass not ``whole``: per task ``begin()`` a state,
        ``add(state, table, y, f, marks)`` each block, and ``end(state)`` gives columns. y - f is what the trees with ``weights`` leave."""
        blocks, known = (self.blocks, self.known) if whole or self.sample is None else (self.sample, self.sample_known)
        known = np.append(known, np.zeros(len(weights) - len(known)))
        behind = [(t.feature, t.cut, t.child, (w - k) * np.array(t.value))
                  for w, k, t in zip(weights, known, self.trees) if w != k]
        count = len(self.names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = begin()
            for batch in batches:
                for rows, bins, y, mark in zip(*(c.to_pylist() for c in batch.columns)):
                    table = np.frombuffer(bins, np.uint8).reshape(count, rows)
                    f = np.zeros(rows)
                    for feature, cut, child, change in behind:
                        f += change[leaf_of(table, feature, cut, child)]
                    marks = np.frombuffer(mark, np.uint64) if mark else np.broadcast_to(np.uint64(0), rows)
                    result = add(state, table, np.frombuffer(y, np.float64), f, marks)
                    if result is not None:
                        yield result
            if end is not None:
                yield end(state)

        return blocks.coalesce(self.tasks).mapInArrow(run, schema)

    def refresh(self) -> None:
        """Write the blocks anew, less today's predictions."""
        self._write("blocks", self._pass(self.weights, BLOCK, lambda: None, lambda _, table, y, f, mark: _block(table, y - f, mark),
                                         None, whole=True))
        self.known = self.weights.copy()

    def draw(self, turn: int) -> None:
        """Write the rows of a turn's sample, less today's predictions."""
        seed, share = self.how.seed, self.how.rows

        def add(_, table, y, f, marks):
            inside = np.flatnonzero(drawn(marks, seed, turn, share))
            return _block(table[:, inside], (y - f)[inside], None) if len(inside) else None

        self._write("sample", self._pass(self.weights, BLOCK, lambda: None, add, None, whole=True))
        self.sample_known = self.weights.copy()

    def share(self) -> float:
        """The share of the rows of a pass that belong to the turn's sample: all, if the sample is written."""
        return 1.0 if self.sample is not None else self.how.rows

    def quantiles(self, weights: np.ndarray, turn: int | None, q: float, tree: Grown | None, absolute: bool) -> dict[int, float]:
        """The quantile of (absolute) residuals of a turn's sample, or of all rows, by leaf of ``tree`` or together. A pass bounds
        the values of the ranks beside the quantile; those strictly between its bounds are sent by the next one, until both are known."""
        start, seed, share = self.start, self.how.seed, 1.0 if turn is None else self.share()
        shape = (tree.feature, tree.cut, tree.child) if tree else ([0], [0], [0])
        bounds = {leaf: (-math.inf, math.inf) for leaf in (tree.leaves() if tree else [0])}
        found = {}

        def add(state, table, y, f, marks):
            rest = np.abs(y - start - f) if absolute else y - start - f
            sample = drawn(marks, seed, turn or 0, share)
            node = leaf_of(table, *shape)
            for leaf, (low, high) in bounds.items():
                x = rest[sample & (node == leaf)]
                inside, outside = state[leaf]
                inside.append(x[(x > low) & (x < high)])
                outside += [np.count_nonzero(part) for part in (x < low, x == low, x == high, x > high)]

        while bounds:
            most = max(16, EXACT // (self.tasks * len(bounds)))
            groups = max(8, min(GROUPS, most))

            def end(state):
                sent = []
                for leaf, (inside, outside) in state.items():
                    x = np.sort(np.concatenate(inside)) if inside else np.zeros(0)
                    if np.count_nonzero(x[1:] != x[:-1]) < most:
                        least, n = np.unique(x, return_counts=True)
                        greatest = least
                    else:
                        ends = np.linspace(0, len(x), groups + 1).astype(np.int64)
                        least, greatest, n = x[ends[:-1]], x[ends[1:] - 1], np.diff(ends)
                    beyond = [-math.inf, *bounds[leaf], math.inf]
                    columns = ([beyond, least], [beyond, greatest], [outside, n])
                    sent.append([leaf, *(np.concatenate(c).tobytes() for c in columns)])
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*sent), (pa.int32(), *[pa.binary()] * 3))], ["leaf", "least", "greatest", "n"])

            sent = self._pass(weights, "leaf int, least binary, greatest binary, n binary",
                              lambda: {leaf: ([], np.zeros(4, np.int64)) for leaf in bounds}, add, end).collect()
            known = {leaf: between([r for r in sent if r["leaf"] == leaf], q) for leaf in bounds}
            bounds = {leaf: value for leaf, value in known.items() if isinstance(value, tuple)}
            found |= {leaf: value for leaf, value in known.items() if leaf not in bounds and value is not None}
        return found

    def sums(self, weights: np.ndarray, turn: int, tree: Grown, nodes: list[int], columns: np.ndarray,
             transition: float | None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Sums of gradients and counts of the sample by feature (of ``columns``) and bin, for some nodes of a tree."""
        start, width, seed, share = self.start, self.width, self.how.seed, self.share()
        cells = len(columns) * width
        shape = tree.feature, tree.cut, tree.child

        def add(state, table, y, f, marks):
            gradient = y - start - f
            if transition is not None:
                gradient = np.clip(gradient, -transition, transition)
            sample = drawn(marks, seed, turn, share)
            node = leaf_of(table, *shape)
            for i, n in enumerate(nodes):
                inside = np.flatnonzero(sample & (node == n))
                part = gradient[inside]
                for j, c in enumerate(columns):
                    cell, of = table[c][inside], slice(j * width, (j + 1) * width)
                    state[0][i, of] += np.bincount(cell, part, width)
                    state[1][i, of] += np.bincount(cell, minlength=width)

        def end(state):
            at, cell = np.nonzero(state[1])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(nodes)[at], pa.int32()), pa.array(cell, pa.int32()), pa.array(state[0][at, cell]),
                 pa.array(state[1][at, cell])], ["node", "cell", "g", "n"])

        found = self._pass(weights, "node int, cell int, g double, n long",
                           lambda: (np.zeros((len(nodes), cells)), np.zeros((len(nodes), cells), np.int64)), add, end)
        found = found.groupBy("node", "cell").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toArrow()
        result = {n: (np.zeros(cells), np.zeros(cells, np.int64)) for n in nodes}
        node, cell, g, n = (found.column(c).to_numpy() for c in ("node", "cell", "g", "n"))
        for name, (gs, ns) in result.items():
            mine = node == name
            gs[cell[mine]], ns[cell[mine]] = g[mine], n[mine]
        return {k: (g.reshape(len(columns), width), n.reshape(len(columns), width)) for k, (g, n) in result.items()}

    def grow(self, weights: np.ndarray, number: int, transition: float | None) -> Grown:
        """One tree on the residuals of the trees with ``weights``."""
        how, turn = self.how, number // self.how.rows_every
        by_tree = how.columns_by == "tree"
        columns = chosen(len(self.names), how.columns if by_tree else 1.0, how.seed, number)
        tree, level, known = Grown(), {0: 0}, self.sums(weights, turn, Grown(), [0], columns, transition)
        totals = {0: tuple(float(s[0].sum()) if s.size else 0.0 for s in known[0])}
        cuts: dict[int, tuple | None] = {}

        def judge(nodes):
            for n in nodes:
                allowed = np.ones(len(columns), bool)
                if not by_tree:
                    allowed = np.isin(columns, chosen(len(self.names), how.columns, how.seed, number, n + 1))
                cuts[n] = how.best_cut(*known[n], allowed) if how.depth is None or level[n] < how.depth else None

        judge([0])
        while ready := [n for n, cut in cuts.items() if cut is not None]:
            if how.leaves is not None:
                room = how.leaves - len(tree.leaves())
                ready = [max(ready, key=lambda n: cuts[n][0])] if room > 0 else []
                if not ready:
                    break
            pairs = []
            for n in ready:
                _, feature, cut = cuts.pop(n)
                g, count = known[n][0][feature, :cut + 1].sum(), known[n][1][feature, :cut + 1].sum()
                left, right = tree.split(n, columns[feature], cut)
                totals[left], totals[right] = (g, count), (totals[n][0] - g, totals[n][1] - count)
                level[left] = level[right] = level[n] + 1
                pairs.append((n, left, right))
            if how.leaves is not None and len(tree.leaves()) >= how.leaves:
                break
            pairs = [p for p in pairs if how.depth is None or level[p[1]] < how.depth]
            # The larger child is what its parent has more than the smaller.
            small = {p[0]: min(p[1:], key=lambda n: totals[n][1]) for p in pairs}
            if small:
                fresh = self.sums(weights, turn, tree, list(small.values()), columns, transition)
                for n, left, right in pairs:
                    other = right if small[n] == left else left
                    count = known[n][1] - fresh[small[n]][1]
                    known[small[n]], known[other] = fresh[small[n]], (
                        np.where(count > 0, known[n][0] - fresh[small[n]][0], 0.0), count)
                    del known[n]
                judge([n for p in pairs for n in p[1:]])
        for leaf in tree.leaves():
            g, n = totals[leaf]
            tree.value[leaf] = float(how.shrunk(g) / (n + how.l2)) if n else 0.0
        if transition is not None:
            self.clipped_means(weights, turn, tree, transition)
        return tree

    def clipped_means(self, weights: np.ndarray, turn: int, tree: Grown, transition: float) -> None:
        """Leaf values of Huber's loss: the median residual plus the mean of the rest, clipped at the transition."""
        start, leaves, seed, share = self.start, tree.leaves(), self.how.seed, self.share()
        shape = tree.feature, tree.cut, tree.child
        middle = self.quantiles(weights, turn, 0.5, tree, False)
        medians = np.array([middle.get(i, 0.0) for i in range(len(tree.child))])

        def add(state, table, y, f, marks):
            sample = drawn(marks, seed, turn, share)
            node = leaf_of(table, *shape)[sample]
            rest = np.clip((y - start - f)[sample] - medians[node], -transition, transition)
            state[0] += np.bincount(node, rest, len(medians))
            state[1] += np.bincount(node, minlength=len(medians))

        def end(state):
            return pa.RecordBatch.from_arrays([pa.array(leaves, pa.int32()), pa.array(state[0][leaves]), pa.array(state[1][leaves])],
                                              ["leaf", "g", "n"])

        found = self._pass(weights, "leaf int, g double, n double", lambda: [np.zeros(len(medians)), np.zeros(len(medians))], add, end)
        for leaf, g, n in found.groupBy("leaf").agg(F.sum("g"), F.sum("n")).collect():
            tree.value[leaf] = float(medians[leaf] + g / n) if n else 0.0

    def run(self) -> tuple[list[Grown], np.ndarray]:
        how = self.how
        if how.loss == "huber":
            self.start = self.quantiles(self.weights, None, 0.5, None, False).get(0) or 0.0
        else:
            total = self._pass(self.weights, "g double, n long", lambda: [0.0, 0], _add_up, _totals)
            g, n = total.agg(F.sum("g"), F.sum("n")).first()
            self.start = g / n if n else 0.0
        for number in range(how.n_trees):
            dropped = self.dropped(number)
            weights = self.weights.copy()
            weights[dropped] = 0.0
            turn = number // how.rows_every
            if how.rows < 1 and how.rows_every > 1 and number % how.rows_every == 0:
                self.draw(turn)
            transition = None
            if how.loss == "huber":
                transition = self.quantiles(weights, turn, how.quantile, None, True).get(0, 0.0)
            tree = self.grow(weights, number, transition)
            self.trees.append(tree)
            k = len(dropped)
            self.weights[dropped] *= k / (k + 1)
            self.weights = np.append(self.weights, how.rate / (k + 1))
            if (number + 1) % REFRESH == 0 and number + 1 < how.n_trees:
                self.refresh()
        return self.trees, self.weights

    def dropped(self, number: int) -> np.ndarray:
        """Earlier trees that a round leaves out, by the seed."""
        how = self.how
        draw = np.random.default_rng([how.seed, 7919, number])
        if not how.drop or not number or draw.random() < how.skip_drop:
            return np.zeros(0, np.int64)
        out = np.flatnonzero(draw.random(number) < how.drop)
        if not len(out):
            out = draw.integers(0, number, 1)
        return np.sort(draw.permutation(out)[:how.most_dropped])


def _block(table: np.ndarray, y: np.ndarray, marks: np.ndarray | None) -> pa.RecordBatch:
    held = [np.ascontiguousarray(table).tobytes(), y.tobytes(), b"" if marks is None else marks.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *(pa.array([x], pa.binary()) for x in held)],
                                      ["rows", "bins", "y", "mark"])


def _add_up(state, table, y, f, marks):
    state[0] += float(y.sum())
    state[1] += len(y)


def _totals(state):
    return pa.RecordBatch.from_arrays([pa.array([state[0]]), pa.array([state[1]])], ["g", "n"])


class BoostedFit(Fitted):
    """Sum of trees. A row with a missing feature has no prediction."""

    def __init__(self, features=None, start=0.0, trees=(), prediction="prediction"):
        super().__init__(**({"features": list(features), "start": start, "trees": list(trees), "prediction": prediction}
                            if features is not None else {}))

    def _transform(self, df: DataFrame) -> DataFrame:
        start, features = self["start"], self["features"]
        trees = [[np.array(t[k]) for k in ("feature", "cut", "child", "value")] for t in self["trees"]]
        if not features:
            return df.withColumn(self["prediction"], F.lit(float(start)))

        @F.pandas_udf("double")
        def predict(*columns: pd.Series) -> pd.Series:
            table = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
            total = np.full(len(table), float(start))
            for feature, cut, child, value in trees:
                total += value[node_of(table, feature, cut, child)]
            total[np.isnan(table).any(axis=1)] = np.nan
            return pd.Series(total)

        found = predict(*(col(c).cast("double") for c in features))
        return df.withColumn(self["prediction"], missing_if_nan(found))


def fit_boosting(df, features, target, prediction="prediction", **params) -> BoostedFit:
    return Boosting(**params).fit(df, features, target, prediction)


runs_in_tasks(__name__)
