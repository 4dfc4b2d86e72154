"""Base classes of fitted steps: ML stages whose constants are JSON values."""

from __future__ import annotations

from pyspark import keyword_only  # noqa: F401  (re-exported for subclasses)
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable


class _Configured(Params):
    """One ``config`` param holds every constant, so save and load need no code."""

    config = Param(Params._dummy(), "config", "constants of this step")

    def __init__(self, **config):
        super().__init__()
        if config:
            self._set(config=config)

    def __getitem__(self, name):
        return self.getOrDefault(self.config)[name]

    def get(self, name, default=None):
        return self.getOrDefault(self.config).get(name, default)


class Step(_Configured, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer with nothing to learn."""


class Learner(_Configured, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator; ``fit`` returns a ``Fitted``."""


class Fitted(_Configured, Model, DefaultParamsReadable, DefaultParamsWritable):
    """What a learner found; ``transform`` applies it to any frame."""


def unique(names, what: str = "column") -> list[str]:
    """Drop repeats, with a warning; a doubled column would be a doubled feature."""
    import warnings

    out = list(dict.fromkeys(names))
    if len(out) < len(list(names)):
        warnings.warn(f"repeated {what} names ignored", stacklevel=3)
    return out
