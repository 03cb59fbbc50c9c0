"""Sinks: tables, CSV in declared order, JSON, reports, metadata."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: str | None = None, sort_by: str | None = None, rows_per_file: int = 2_000_000) -> int:
    """Replace a Parquet table; returns its rows, counted while writing.

    ``sort_by`` sorts within the written files, so that row groups can be skipped.  With
    ``partition_by`` the rows are divided by that value and, for values of many rows, by as
    many salts as they have files of ``rows_per_file``, so that no value is one task.
    """
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        files = df.groupBy(F.col(partition_by).alias("_v")).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).cast("int").alias("_files"))
        out = out.join(files, F.col(partition_by).eqNullSafe(F.col("_v")), "left").withColumn("_salt", F.floor(F.rand(7) * F.col("_files")).cast("int"))
        out = out.repartition(partition_by, "_salt").drop("_v", "_files", "_salt")
    if sort_by:
        out = out.sortWithinPartitions(*filter(None, [partition_by, sort_by]))
    w = out.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, columns: Sequence[str], single: bool = False, crlf: bool = False) -> None:
    """RFC 4180 in the declared column order; absent columns and nulls are empty, blanks around a cell belong to it."""
    out = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns))
    w = (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    (w.option("lineSep", "\r\n") if crlf else w).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def metadata(source: str, years: dict[str, list[int]], counts: dict[str, int]) -> list[tuple[str, str]]:
    """(key, value) rows of a build, lists and counts as JSON."""
    return [("source", source), ("parsed_fiscal_years", json.dumps(years, sort_keys=True)), ("counts", json.dumps(counts, sort_keys=True))]


def todo(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows not done yet: what a resumed run has to do."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")
