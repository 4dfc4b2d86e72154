"""Reading tables, writing predictions, storing fitted models."""

from .sinks import load_model, save_model, write_predictions
from .tables import head, load_table, normalize_missing, shape

__all__ = ["head", "load_model", "load_table", "normalize_missing", "save_model", "shape",
           "write_predictions"]
