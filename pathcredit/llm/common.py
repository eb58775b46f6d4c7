"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathcredit.config import materialize

__all__ = ["all_columns", "ascii_lower", "crc32_of_id", "fresh", "input_order", "materialize", "whole_text"]


def fresh(name: str) -> str:
    """A column name no input can clash with."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def whole_text(text: Column | str) -> Column:
    """The text as string, null as the empty string."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("string")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc32_of_id(id_col: Column | str) -> Column:
    """crc32 of the id written as text (null ids count as the empty text)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def all_columns(df: DataFrame) -> list[Column]:
    """Every column of ``df``, whatever characters its name has."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def input_order(df: DataFrame) -> list[Column] | None:
    """Columns of ``df`` that order its rows as they lie in its files, or None when ``df`` is not a file scan."""
    try:
        scanned = df.metadataColumn("_metadata")  # the file source's own, even beside a column of that name
        order = [scanned["file_path"], scanned["row_index"]]
        df.select(*order).schema  # noqa: B018  analysed here
        return order
    except AnalysisException:
        return None
