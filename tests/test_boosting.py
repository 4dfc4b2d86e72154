"""Boosting beside a plain version over the rows themselves."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from gablework.catalog import models as queries
from gablework.models import boosting
from gablework.models.boosting import Boosting
from gablework.plans import presets
from gablework.sources import load_model, save_model

X = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 700
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 30, n) / 4, rng.integers(0, 2, n), rng.normal(0, 1, n).round(1)])
    y = 3 * x[:, 0] - np.abs(x[:, 1] - 4) ** 2 + 5 * x[:, 2] * (x[:, 3] > 0) + rng.standard_t(2, n)
    frame = pd.DataFrame(x, columns=X).assign(y=y, id=np.arange(n))
    marks = [r["m"] for r in spark.range(n).selectExpr("id", "xxhash64(id) m").orderBy("id").collect()]
    return spark.createDataFrame(frame).repartition(5), x, y, np.array(marks, np.int64).view(np.uint64)


def plain_tree(how, x, g, rows, number):
    """Leaves as (rows of the sample, function to a mask of all rows), grown on gradients."""
    def score(rows):
        s = np.sign(g[rows].sum()) * max(abs(g[rows].sum()) - how.l1, 0)
        return s * s / (len(rows) + how.l2) if len(rows) else 0.0

    def best(rows, depth, node):
        if how.depth is not None and depth >= how.depth:
            return None
        wanted = (number, node + 1) if how.columns_by == "node" else (number,)
        top = None
        for f in boosting.chosen(x.shape[1], how.columns, how.seed, *wanted):
            values = np.unique(x[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(left), len(right)) >= max(1, how.leaf):
                    gain = score(left) + score(right) - score(rows)
                    if gain > 1e-9 and (top is None or gain > top[0] + 1e-9):
                        top = gain, f, cut
        return top

    nodes = [(0, 0, rows, np.ones(len(x), bool))]
    done, number_of_nodes, cuts = [], 1, {0: best(rows, 0, 0)}
    while nodes:
        if how.leaves is not None:
            if len(nodes) + len(done) >= how.leaves:
                break
            nodes.sort(key=lambda n: -(cuts[n[0]] or (-1,))[0])
        name, depth, inside, mask = nodes.pop(0)
        if cuts[name] is None:
            done.append((inside, mask))
            continue
        _, f, cut = cuts[name]
        for side in (x[:, f] <= cut, x[:, f] > cut):
            part = inside[side[inside]]
            cuts[number_of_nodes] = best(part, depth + 1, number_of_nodes)
            nodes.append((number_of_nodes, depth + 1, part, mask & side))
            number_of_nodes += 1
    return done + [n[2:] for n in nodes]


def plain_boosting(how, x, y, marks):
    start = np.median(y) if how.loss == "huber" else y.mean()
    outputs, weights = [], []
    for number in range(how.n_trees):
        draw = np.random.default_rng([how.seed, 7919, number])
        dropped = np.zeros(0, int)
        if how.drop and number and draw.random() >= how.skip_drop:
            dropped = np.flatnonzero(draw.random(number) < how.drop)
            dropped = dropped if len(dropped) else draw.integers(0, number, 1)
            dropped = draw.permutation(dropped)[:how.most_dropped]
        rest = y - start - sum((w * o for i, (w, o) in enumerate(zip(weights, outputs)) if i not in dropped), np.zeros(len(y)))
        rows = np.flatnonzero(boosting.drawn(marks, how.seed, number // how.rows_every, how.rows))
        g = rest
        if how.loss == "huber":
            delta = np.quantile(np.abs(rest[rows]), how.quantile)
            g = np.clip(rest, -delta, delta)
        output = np.zeros(len(y))
        for inside, mask in plain_tree(how, x, g, rows, number):
            if how.loss == "huber":
                m = np.median(rest[inside])
                output[mask] = m + np.clip(rest[inside] - m, -delta, delta).mean()
            else:
                s = g[inside].sum()
                output[mask] = np.sign(s) * max(abs(s) - how.l1, 0) / (len(inside) + how.l2)
        for i in dropped:
            weights[i] *= len(dropped) / (len(dropped) + 1)
        outputs.append(output)
        weights.append(how.rate / (len(dropped) + 1))
    return start + sum(w * o for w, o in zip(weights, outputs))


@pytest.mark.parametrize("how", [
    Boosting(n_trees=3, depth=2),
    Boosting(n_trees=12, depth=3, loss="huber", rows=0.7, columns="sqrt", columns_by="node", leaf=10, rate=0.3),
    Boosting(n_trees=5, depth=None, leaves=5, l1=20.0, l2=5.0, rows=0.7, rows_every=2, columns=0.7, leaf=10),
    Boosting(n_trees=13, depth=2, drop=0.4, skip_drop=0.3, rate=0.5),
    Boosting(n_trees=6, depth=3, leaves=4, drop=0.5, skip_drop=0.0, most_dropped=2, loss="huber", quantile=0.8, rate=0.5),
], ids=["levels", "huber", "leaves", "dart", "both"])
def test_plain_version(data, how, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 4)
    df, x, y, marks = data
    ours = how.fit(df, X, "y", key="id").transform(df).toPandas().sort_values("id")
    assert np.allclose(ours["prediction"], plain_boosting(how, x, y, marks), rtol=1e-9, atol=1e-9)
    assert 1 - ((ours["prediction"] - y) ** 2).mean() / y.var() > 0.1


def test_blocks_of_any_size_give_one_model(data, monkeypatch):
    df = data[0]
    how = Boosting(n_trees=3, depth=2, loss="huber")
    one = how.fit(df, X, "y", key="id").transform(df).toPandas().sort_values("id")["prediction"]
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 30)
    assert np.allclose(how.fit(df.repartition(2), X, "y", key="id").transform(df).toPandas().sort_values("id")["prediction"], one)


def test_groups_bound_the_rank(data, monkeypatch):
    """Values sent in groups move a median by no more than their share of the ranks."""
    monkeypatch.setattr(boosting, "EXACT", 20), monkeypatch.setattr(boosting, "GROUPS", 10)
    df, _, y, _ = data
    start = Boosting(n_trees=0, loss="huber").fit(df, X, "y")["start"]
    assert abs((y < start).mean() - 0.5) <= 1 / 20


def test_quantiles_are_exact_at_any_size(spark):
    """A task with over 16,384 values of a leaf sent groups by their middle values, so results changed with the size."""
    df = spark.range(40_000).selectExpr("id % 3 AS a", "abs(xxhash64(id)) % 1000003 / 7.0D AS y")
    y = df.toPandas()["y"].to_numpy()
    assert Boosting(n_trees=0, loss="huber").fit(df, ["a"], "y")["start"] == np.median(y)


def test_quantiles_of_many_tasks_and_passes(data, monkeypatch):
    """Few values sent at once, so that each quantile takes several passes over several tasks."""
    df, x, y, marks = data
    seen = []
    between = boosting.between
    monkeypatch.setattr(boosting, "between", lambda sent, q: seen.append(len(sent)) or between(sent, q))
    for name, value in (("EXACT", 16), ("GROUPS", 8), ("TASK_CELLS", 1000), ("BLOCK_ROWS", 40)):
        monkeypatch.setattr(boosting, name, value)
    how = Boosting(n_trees=4, depth=2, loss="huber", rows=0.8, rate=0.5, leaf=10)
    ours = how.fit(df, X, "y", key="id").transform(df).toPandas().sort_values("id")
    assert np.allclose(ours["prediction"], plain_boosting(how, x, y, marks), rtol=1e-9, atol=1e-9)
    assert max(seen) > 1 and len(seen) > 2 * (1 + 4 * (1 + 4))


@pytest.mark.parametrize("q", [0.0, 0.31, 0.5, 0.9, 1.0])
def test_quantiles_with_ties(spark, monkeypatch, q):
    for name, value in (("EXACT", 16), ("GROUPS", 8)):
        monkeypatch.setattr(boosting, name, value)
    y = np.concatenate([np.repeat([-3.0, 0.0, 2.5, 7.0], [400, 900, 300, 700]), np.linspace(-4, 9, 333)])
    df = spark.createDataFrame(pd.DataFrame({"a": 1.0, "y": y}))
    rows = df.selectExpr("a", "y", f"xxhash64(y) AS {boosting.MARK}")
    with boosting._Training(Boosting(), rows, ["a"], "y", False, [[]]) as work:
        assert work.quantiles(work.weights, None, q, None, False)[0] == pytest.approx(np.quantile(y, q), abs=1e-12)
        assert work.quantiles(work.weights, None, q, None, True)[0] == pytest.approx(np.quantile(np.abs(y), q), abs=1e-12)


def test_leafwise_query_grows_every_tree_of_its_preset(spark, monkeypatch):
    """It grew 60 of the 250 trees."""
    seen = []
    fit = Boosting.fit

    def watched(how, df, features, target, **rest):
        seen.append((how, df.count()))
        return fit(Boosting(n_trees=1), df, features, target, **rest)

    monkeypatch.setattr(Boosting, "fit", watched)
    own = spark.range(40).selectExpr("id", "1000.0D * (1 + id % 5) sale_price", *(f"id % {k + 2} {c}" for k, c in enumerate(queries.COMPLETE)))
    assert queries.gbt_leafwise(own).where("prediction is not null").count() == 40
    assert seen == [(presets.leafwise(), 40)] and seen[0][0].n_trees == 250


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).selectExpr("id / 7.0 AS a", "IF(id < 2500, 1.0, 3.0) AS y")
    edges, = boosting.bin_edges(df, ["a"], 32)
    assert 25 < len(edges) <= 31 and edges == sorted(edges)
    fit = Boosting(n_trees=1, rate=1.0, depth=1, bins=32).fit(df, ["a"], "y")
    assert fit.transform(df).where("abs(prediction - y) > 0.2").count() == 0


def test_odd_rows(spark, tmp_path):
    rows = [(1.0, 2.0, 1.0), (2.0, 1.0, 3.0), (None, 2.0, 9.0), (float("nan"), 1.0, 9.0), (3.0, 4.0, None), (2.0, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    model = Boosting(n_trees=2, depth=1, rate=1.0).fit(df, ["a", "b"], "y")
    found = [r["prediction"] for r in model.transform(df).collect()]
    assert found[2] is None and found[3] is None and found[1] == found[5] == pytest.approx(3.0) and found[0] == pytest.approx(1.0)
    save_model(model, f"{tmp_path}/model")
    assert [r["prediction"] for r in load_model(f"{tmp_path}/model").transform(df).collect()] == found
    empty = Boosting(n_trees=2).fit(df.where("false"), ["a", "b"], "y")
    assert empty.transform(df).first()["prediction"] == 0.0
    constant = Boosting(n_trees=2, loss="huber").fit(df.selectExpr("a", "1.0 AS b", "5.0 AS y"), ["b"], "y")
    assert constant.transform(df.selectExpr("1.0 AS b")).first()["prediction"] == 5.0


def test_wrong_parameters():
    for wrong in ({"loss": "cubic"}, {"bins": 300}, {"depth": None}):
        with pytest.raises(ValueError):
            Boosting(**wrong)


def test_leaves_by_cuts_are_those_by_rows():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 9, (4, 500)).astype(np.uint8)
    for cuts in (0, 1, 4, 31, 60):  # few cuts go by whole columns, many by rows
        tree = boosting.Grown()
        for _ in range(cuts):
            tree.split(int(rng.choice(tree.leaves())), rng.integers(4), rng.integers(8))
        shape = tree.feature, tree.cut, tree.child
        assert (boosting.leaf_of(bins, *shape) == boosting.node_of(bins.T, *shape)).all()


def test_trees_of_one_sample_read_its_rows_only(data, monkeypatch):
    """Trees that share a sample pass over blocks of the drawn rows, without marks, and not over the whole table."""
    df, x, y, marks = data
    how = Boosting(n_trees=4, rate=0.3, depth=None, leaves=4, rows=0.5, rows_every=2)
    seen = []
    sums = boosting._Training.sums

    def watched(work, weights, turn, *rest):
        rows = work.sample.selectExpr("sum(rows) n", "max(length(mark)) m").first()
        seen.append((turn, rows["n"], rows["m"]))
        return sums(work, weights, turn, *rest)

    monkeypatch.setattr(boosting._Training, "sums", watched)
    how.fit(df, X, "y", key="id")
    drawn = {turn: int(boosting.drawn(marks, how.seed, turn, how.rows).sum()) for turn in (0, 1)}
    assert {(turn, n, m) for turn, n, m in seen} == {(turn, n, 0) for turn, n in drawn.items()}
