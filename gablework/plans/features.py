"""Feature plans: named blocks of columns, each filled, encoded or scaled its own way."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

from ..functions import text
from ..functions.columns import col
from ..operators import distribution as D
from ..operators.profile import fit_moments
from ..operators.transformers import (QUARTILES, RobustScale, _or_one, learn_levels, level_name, place,
                                      quartiles_of, yeo_johnson_value)
from ..session import in_compiled_methods, kept, side_by_side
from ..stage import Fitted, Learner, unique


# A column of this name passes through every plan: whole rows travel in it.
CARRIED = "_row"


def block(name: str, columns: Iterable[str] | None = None, fill=None, one_hot: bool = False,
          scale: Sequence[str] = (), drop: str | None = "first", unseen: str = "error") -> dict:
    """One block. ``fill`` is a value or {column: value}; ``scale`` lists any of
    "yeo_johnson", then "standard" or "robust"."""
    columns = list(columns if columns is not None else fill)
    bad = set(scale) - {"yeo_johnson", "standard", "robust"}
    if bad:
        raise ValueError(f"unknown scaling {sorted(bad)}")
    return {"name": name, "columns": unique(columns), "fill": dict(fill) if isinstance(fill, Mapping) else fill,
            "one_hot": one_hot, "scale": list(scale), "drop": drop, "unseen": unseen}


class FeaturePlan(Learner):
    """Columns in no block are dropped, but for ``keep`` (keys, target). ``final="robust"``
    scales every resulting column once more."""

    def __init__(self, blocks: Sequence[dict] = (), keep: Iterable[str] = (), final: str | None = None):
        if not blocks:
            super().__init__()
            return
        columns = [c for b in blocks for c in b["columns"]]
        twice = {c for c in columns if columns.count(c) > 1}
        if twice:
            raise ValueError(f"columns in two blocks: {sorted(twice)}")
        super().__init__(blocks=list(blocks), keep=list(keep), final=final)

    def keeping(self, keep: Iterable[str]) -> FeaturePlan:
        return FeaturePlan(self["blocks"], unique([*self["keep"], *keep]), self["final"])

    def _fit(self, df: DataFrame) -> FeaturePlanModel:
        blocks = self["blocks"]
        encoded = [c for b in blocks if b["one_hot"] for c in b["columns"]]
        scaled = {c: b["scale"] for b in blocks if b["scale"] for c in b["columns"]}
        learned: dict = {}
        filled = _filled_text(df, blocks)
        with kept(df.selectExpr(*[text.alias(filled[c], c) for c in [*encoded, *scaled]])) as source:
            levels, scales = side_by_side([lambda: learn_levels(source, encoded), lambda: _learn_scales(source, scaled)])
        learned.update({c: {"levels": v} for c, v in zip(encoded, levels)})
        learned.update(scales)
        model = FeaturePlanModel(blocks, learned, self["keep"])
        if self["final"] == "robust":
            names = model.feature_names
            finish = RobustScale(names).fit(model.transform(df).select([col(n) for n in names]))
            model = FeaturePlanModel(blocks, learned, self["keep"],
                                     {n: [m, w] for n, m, w in finish._each()})
        return model


def _filled_text(df: DataFrame, blocks) -> dict[str, str]:
    """{column: SQL of its filled value}."""
    types, out = {f.name: f.dataType.simpleString() for f in df.schema.fields}, {}
    for b in blocks:
        for c in b["columns"]:
            value = b["fill"].get(c) if isinstance(b["fill"], dict) else b["fill"]
            out[c] = text.name(c) if value is None else (
                f"coalesce({text.name(c)}, CAST({text.literal(value)} AS {types[c]}))")
    return out


def _learn_scales(source: DataFrame, scaled: dict[str, list[str]]) -> dict:
    columns = list(scaled)
    if not columns:
        return {}
    found = D.ranges(source, columns)
    learned = {c: {"lambda": None, "center": 0.0, "width": 1.0} for c in columns}
    powered = [i for i, c in enumerate(columns) if "yeo_johnson" in scaled[c]]
    robust = [i for i, c in enumerate(columns) if "robust" in scaled[c]]
    if powered or robust:
        with D.weighted_values(source, columns, found) as values:
            fits = D.lambdas_of(values, found, powered)
            spots = D.quantiles_of(values, found, robust, QUARTILES)
        for i, (lam, _) in zip(powered, fits):
            learned[columns[i]]["lambda"] = lam
        for i, at in zip(robust, spots):
            # the transform is increasing, so order statistics carry over
            lam = learned[columns[i]]["lambda"]
            low, mid, high = quartiles_of(at, (lambda x, lam=lam: yeo_johnson_value(x, lam)) if lam is not None
                                          else (lambda x: x))
            learned[columns[i]].update(center=mid, width=_or_one(high - low))
    for r, c in zip(found, columns):
        if scaled[c] == ["standard"]:
            learned[c].update(center=r.mean or 0.0, width=_or_one(r.std))
    standard = [c for c in columns if scaled[c] == ["yeo_johnson", "standard"]]
    if standard:
        moments = fit_moments(source.selectExpr(*[
            text.alias(_power(text.name(c), learned[c]["lambda"]), c) for c in standard]), standard)
        for c in standard:
            learned[c].update(center=moments[c][0], width=_or_one(moments[c][1]))
    return learned


def _power(x: str, lam: float | None) -> str:
    x = f"CAST({x} AS DOUBLE)"
    return x if lam is None else text.yeo_johnson(x, lam)


def _scaled(x: str, center: float, width: float) -> str:
    return f"({x} - {text.number(center)}) / {text.number(width)}"


class FeaturePlanModel(Fitted):
    def __init__(self, blocks=(), learned=None, keep=(), final=None):
        super().__init__(**({"blocks": list(blocks), "learned": learned, "keep": list(keep), "final": final or {}}
                            if blocks else {}))

    @property
    def feature_names(self) -> list[str]:
        names = []
        for b in self["blocks"]:
            for c in b["columns"]:
                if b["one_hot"]:
                    first = 1 if b["drop"] == "first" else 0
                    names += [level_name(c, v) for v in self["learned"][c]["levels"][first:]]
                else:
                    names.append(c)
        return names

    def _transform(self, df: DataFrame) -> DataFrame:
        in_compiled_methods(df.sparkSession)
        blocks, learned, final = self["blocks"], self["learned"], self["final"]
        keep = [text.name(c) for c in [*self["keep"], CARRIED] if c in df.columns]
        filled, first_pass, out = _filled_text(df, blocks), [], []
        for b in blocks:
            for c in b["columns"]:
                inner = text.name(f"_in_{c}")
                if b["one_hot"]:
                    # the position is found once per row and compared once per level
                    levels, first = learned[c]["levels"], 1 if b["drop"] == "first" else 0
                    out += [text.alias(f"CAST({inner} = {k + 1} AS DOUBLE)", level_name(c, levels[k]))
                            for k in range(first, len(levels))]
                    first_pass.append((c, levels, b["unseen"]))
                    continue
                first_pass.append((c, None, None))
                x = _power(inner, learned[c]["lambda"] if b["scale"] else None)
                if b["scale"]:
                    x = _scaled(x, learned[c]["center"], learned[c]["width"])
                out.append(text.alias(x, c))
        ready = df.selectExpr(*keep, *[text.alias(filled[c], f"_in_{c}") for c, _, _ in first_pass])
        placed = ready.selectExpr(*keep, *[
            text.name(f"_in_{c}") if levels is None else text.alias(place(f"_in_{c}", levels, unseen, c), f"_in_{c}")
            for c, levels, unseen in first_pass])
        wide = placed.selectExpr(*keep, *out)
        if final:
            wide = wide.selectExpr(*keep, *[text.alias(_scaled(text.name(n), *final[n]), n) for n in self.feature_names])
        return wide
