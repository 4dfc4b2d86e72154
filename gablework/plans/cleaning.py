"""Cleaning rules as data: learned once on the training table, applied to any."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions import columns as C
from ..functions.columns import col
from ..operators.derive import GRADES
from ..operators.distribution import best_powers, linspace
from ..operators.lookup import TableHolder
from ..operators.missing import GroupModeImputer, GroupModeModel, fill_defaults
from ..stage import Learner

# Rules in the order they are applied. Each reads the columns as the ones before left
# them, but ``power``, which is learned on the raw table and reads a raw column.
RULES = {
    "defaults": "{column: value} for missing values, first of all",
    "modes": "[column]: filled with the group's most frequent value",
    "equals": "{column: value}: becomes a flag",
    "recode": "{column: {old: new}}",
    "merge": "{column: (values, label)}",
    "clamp": "{column: lowest}",
    "keep": "{column: (value, other)}",
    "half_wave": "{new: month column}",
    "power": "{new: column}: raised to the exponent that fits the target best",
    "present": "{new flag: column}",
    "diffs": "{new: (a, b)}",
    "powers": "{new: (column, exponent)}",
    "grades": "[column]: letters to integers",
    "sums": "{new: [columns]}",
    "weights": "{new: {column: weight}}",
    "nonzero": "{new flag: column}",
    "same": "{new flag: (a, b)}",
}


def _plain(value):
    """Mappings as lists of pairs: JSON would turn integer keys into texts."""
    if isinstance(value, Mapping):
        return [[k, _plain(v)] for k, v in value.items()]
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


class CleaningRules(Learner):
    """``fit`` learns group values and exponents; the model is one projection and one
    look-up join."""

    def __init__(self, group: str | None = None, target: str | None = None, strategy: str = "mode",
                 grid=None, **rules):
        unknown = set(rules) - set(RULES)
        if unknown:
            raise ValueError(f"unknown rules {sorted(unknown)}")
        if not rules:
            super().__init__()
            return
        super().__init__(group=group, target=target, strategy=strategy,
                         grid=list(grid or linspace(2.5, 3.5, 50)),
                         rules={name: _plain(rule) for name, rule in rules.items()})

    def _fit(self, df: DataFrame) -> CleaningModel:
        rules = self["rules"]
        imputer = None
        if rules.get("modes"):
            imputer = GroupModeImputer(self["group"], rules["modes"], self["strategy"]).fit(df)
        powers = rules.get("power", [])
        columns = [c for _, c in powers]
        exponents = [p for p, _ in best_powers(df, columns, self["target"], self["grid"])] if columns else []
        return CleaningModel(rules, imputer.getOrDefault("config") if imputer else None, exponents)


class CleaningModel(TableHolder):
    """Fitted rules. A saved model holds the group values that it fills in."""

    def __init__(self, rules=None, modes=None, exponents=()):
        super().__init__(**({"rules": rules, "modes": modes, "exponents": list(exponents)} if rules else {}))

    def frozen(self) -> dict | None:
        return self["modes"]["table"] if self["modes"] else None

    def take_from(self, path: str) -> None:
        modes = {**self["modes"], "table": {**self["modes"]["table"], "path": path}}
        self._set(config={**self.getOrDefault(self.config), "modes": modes})

    def _transform(self, df: DataFrame) -> DataFrame:
        rules = {name: self["rules"].get(name, []) for name in RULES}
        df = fill_defaults(df, dict(rules["defaults"])) if rules["defaults"] else df
        if self["modes"]:
            m = self["modes"]
            df = GroupModeModel(m["key"], m["columns"], m["table"]).transform(df)
        changed = {
            **{c: C.equals(col(c), v) for c, v in rules["equals"]},
        }
        df = df.withColumns(changed) if changed else df
        for build in (
            lambda: {c: C.replace_values(col(c), dict(map(tuple, m))) for c, m in rules["recode"]},
            lambda: {c: C.merge_into(col(c), vals, label) for c, (vals, label) in rules["merge"]},
            lambda: {c: C.at_least(col(c), low) for c, low in rules["clamp"]},
            lambda: {c: C.keep_only(col(c), v, other) for c, (v, other) in rules["keep"]},
            lambda: {**{new: C.half_wave(col(c)) for new, c in rules["half_wave"]},
                     **{new: F.pow(col(c), F.lit(p)) for (new, c), p in zip(rules["power"], self["exponents"])},
                     **{new: col(c).isNotNull() for new, c in rules["present"]},
                     **{new: col(a) - col(b) for new, (a, b) in rules["diffs"]},
                     **{new: F.pow(col(c), F.lit(float(p))) for new, (c, p) in rules["powers"]}},
            lambda: {c: C.grade(col(c), GRADES) for c in rules["grades"]},
            lambda: {**{new: C.total([col(c) for c in cs]) for new, cs in rules["sums"]},
                     **{new: C.weighted([(col(c), w) for c, w in ws]) for new, ws in rules["weights"]},
                     **{new: C.differs(col(c), 0) for new, c in rules["nonzero"]},
                     **{new: C.same(col(a), col(b)) for new, (a, b) in rules["same"]}},
        ):
            columns = build()
            df = df.withColumns(columns) if columns else df
        return df
