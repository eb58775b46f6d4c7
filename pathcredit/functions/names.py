"""Human-readable channel and model names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathcredit.constants import MISSING_NAME_PREFIX, MODEL_LABELS, ROOT_LABELS, ROOT_PREFIXES


def channel_name(code: Column, root: Column, sub: Column, looked_up: Column) -> Column:
    """Fixed names for roots without sub-ids; prefix + dictionary name (or ``код N``) otherwise;
    the raw code when the root is not a known number."""
    expr = None
    for r in sorted(set(ROOT_LABELS) | set(ROOT_PREFIXES)):
        if r in ROOT_LABELS:
            value = F.lit(ROOT_LABELS[r])
        else:
            fallback = F.concat(F.lit(MISSING_NAME_PREFIX), sub.cast("string"))
            value = F.concat(F.lit(ROOT_PREFIXES[r]), F.coalesce(F.nullif(looked_up, F.lit("")), fallback))
        expr = F.when(root == r, value) if expr is None else expr.when(root == r, value)
    return expr.otherwise(code)


def model_name(model: Column) -> Column:
    expr = None
    for key, label in MODEL_LABELS.items():
        expr = F.when(model == key, F.lit(label)) if expr is None else expr.when(model == key, F.lit(label))
    return expr
