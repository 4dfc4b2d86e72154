"""Every operator as a query over the test tables, with the SQL that must agree.

``QUERIES`` maps a name to a function of (spark, folder); ``ORACLES`` maps a name to
the SQL text, for operators that SQL can express.
"""

from .registry import ORACLES, QUERIES

from . import prepare, profile, features, models  # noqa: E402,F401

__all__ = ["ORACLES", "QUERIES"]
