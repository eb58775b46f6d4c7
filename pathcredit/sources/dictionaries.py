"""Id → name lookup tables for channel sub-ids, loaded from ``id,name`` text files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from pathcredit.constants import DICTIONARY_FILES

BUNDLED_DIR = os.path.join(os.path.dirname(__file__), "dicts")


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``(id int, name string)`` from one file.

    Blank and ``#`` lines are skipped; a line splits at its first comma only, so
    names may contain commas; rows whose id is not an integer (the ``id,name``
    header among them) or whose name is blank are dropped; a missing file is an
    empty table. Parsed with ``read.text`` + regex, not ``read.csv``.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], "id int, name string")
    return parse_lines(lines)


def parse_lines(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, id, name)`` from a text DataFrame's ``value`` lines (rules of :func:`load_dictionary`)."""
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    parts = F.regexp_extract(line, r"^([^,]*),(.*)$", 1), F.regexp_extract(line, r"^([^,]*),(.*)$", 2)
    parsed = lines.select(
        *keep,
        line.alias("line"),
        F.expr("try_cast(regexp_replace(regexp_extract(regexp_replace(value, '^\\\\s+|\\\\s+$', ''), "
               "'^([^,]*),(.*)$', 1), '^\\\\s+|\\\\s+$', '') AS INT)").alias("id"),
        F.regexp_replace(parts[1], r"^\s+|\s+$", "").alias("name"),
    )
    return (parsed.where((F.col("line") != "") & ~F.col("line").startswith("#") & F.col("line").contains(","))
            .where(F.col("id").isNotNull() & (F.col("name") != ""))
            .select(*keep, "id", "name"))


def load_dictionaries(spark: SparkSession, directory: str = BUNDLED_DIR) -> DataFrame:
    """All five lookups as one ``(root_id, id, name)`` table, keyed by the channel root.

    One text scan of the folder; each line's root comes from its file name, so
    other files in the folder are ignored and a missing file contributes no rows.
    """
    try:
        lines = spark.read.option("pathGlobFilter", "*.csv").text(directory)
    except AnalysisException:
        return spark.createDataFrame([], "root_id smallint, id int, name string")
    roots = F.create_map(*[x for root, name in DICTIONARY_FILES.items() for x in (F.lit(name), F.lit(root))])
    tagged = lines.select("value", roots[F.col("_metadata.file_name")].cast("smallint").alias("root_id"))
    d = parse_lines(tagged.where(F.col("root_id").isNotNull()), keep=("root_id",))
    # One id may be listed twice; the first listed name is not defined, keep one deterministically.
    return d.groupBy("root_id", "id").agg(F.min("name").alias("name"))

