"""Sources: CSV files strict and lenient, trees of files, JSON, captured service answers."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.functions import exprs as X

#: File name endings, in order of precedence, and the table they hold.
FILE_TYPES = (
    (r"^legistar_crosswalk\.csv$", None),
    (r"^all_years_initiatives\.csv$", "combined_initiatives"),
    (r"^all_years_awards\.csv$", "combined_awards"),
    (r"_schedule_c_initiatives\.csv$", "schedule_c_initiatives"),
    (r"_schedule_c_awards\.csv$", "schedule_c_awards"),
    (r"_appendix_a_aging\.csv$", "appendix_aging"),
    (r"_appendix_b_local\.csv$", "appendix_local"),
    (r"_appendix_c_youth\.csv$", "appendix_youth"),
    (r"_terms_and_conditions\.csv$", "terms"),
    (r"_transparency_all\.csv$", "transparency"),
    (r"^reso\d+_transparency_designations\.csv$", "transparency_reso"),
    (r"_capital_projects\.csv$", "capital"),
)


class TablesNotBuilt(RuntimeError):
    """The tables of the catalog are not where they should be."""


def detect_type(path: str) -> str | None:
    """The table a file holds, by its name; None for files that are none."""
    name = re.split(r"[\\/]", path)[-1]
    return next((t for p, t in FILE_TYPES if re.search(p, name)), None)


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _csv(spark: SparkSession, multi_line: bool = True):
    """A file whose cells hold no line breaks can be divided over tasks: ``multi_line=False``."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)


def read_csv_strict(spark: SparkSession, path: str | list[str], columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """Trimmed cells, null as empty; a row with another number of fields fails the read."""
    df = _csv(spark, multi_line).option("mode", "FAILFAST").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).option("enforceSchema", False).schema(text_schema(columns)).csv(path)
    return df.select(*(X.trim_all(c).alias(c) for c in columns))


def read_csv_lenient(spark: SparkSession, path: str | list[str], columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """Cells as they stand; absent ones are empty; rows of another width are kept in ``_corrupt``."""
    schema = T.StructType([*text_schema(columns).fields, T.StructField("_corrupt", T.StringType())])
    df = _csv(spark, multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").schema(schema).csv(path)
    first = F.length(F.coalesce(F.col(columns[0]), F.lit("")))  # Spark refuses to read the corrupt column alone
    return df.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns), F.when(first >= 0, F.col("_corrupt")).alias("_corrupt"))


def read_years(spark: SparkSession, glob: str, columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """Every file of a glob with ``year`` (FYNN) and ``fiscal_year`` from its folder."""
    df = _csv(spark, multi_line).schema(text_schema(columns)).csv(glob)
    p = F.col("_metadata.file_path")
    return df.select(X.year_label(p).alias("year"), X.year_in_path(p).alias("fiscal_year"), *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns))


def read_year_list(read: Callable[[int], DataFrame], years: Sequence[int]) -> DataFrame:
    """One table out of one reader per year, with ``fiscal_year`` as a literal."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [read(y).withColumn("fiscal_year", F.lit(y)) for y in years])


def list_files(spark: SparkSession, root: str, pattern: str = r"\.csv$") -> list[str]:
    """Paths below ``root`` on any file system Spark can reach, sorted."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out, it = [], fs.listFiles(path, True)
    while it.hasNext():
        p = it.next().getPath().toString()
        if re.search(pattern, p):
            out.append(p)
    return sorted(out)


def read_tree(spark: SparkSession, root: str, columns: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Tables of a tree of files by type, one read per type over all its files."""
    found: dict[str, list[str]] = {}
    for p in list_files(spark, root):
        t = detect_type(p)
        if t in columns:
            found.setdefault(t, []).append(p)
    return {t: read_csv_lenient(spark, paths, columns[t]) for t, paths in found.items()}


def optional(spark: SparkSession, path: str, schema: T.StructType, read: Callable[[str], DataFrame]) -> tuple[DataFrame, bool]:
    """(table, found): an empty table of the declared schema where the file is missing."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p):
        return read(path), True
    return spark.createDataFrame([], schema), False


def open_tables(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Views on written tables; a missing one raises with its name."""
    out = {}
    for n in names:
        if not list_files(spark, f"{root}/{n}.parquet", r"\.parquet$"):
            raise TablesNotBuilt(f"{root}/{n}.parquet is missing: build the tables first")
        out[n] = spark.read.parquet(f"{root}/{n}.parquet")
        out[n].createOrReplaceTempView(n)
    return out


def read_json_array(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema else r).json(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): whole text files."""
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def resolution_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, seq, date) of resolution documents by sequence; files marked as duplicates are left out."""
    rows = [(p,) for p in list_files(spark, root, r"Transparency-Reso-.*") if "-dup" not in p]
    df = spark.createDataFrame(rows, "path string")
    p = r"(?i)Transparency-Reso-0*(\d+)-(\d{4}-\d{2}-\d{2})"
    return df.select("path", F.regexp_extract("path", p, 1).cast("int").alias("seq"), F.regexp_extract("path", p, 2).alias("date")).orderBy("seq")


class Service:
    """A service client with a pause between calls, growing waits on refusals, and a memory of answers.

    ``fetch(url)`` returns (status, body) and is given by the caller; nothing here opens a
    connection by itself.
    """

    def __init__(self, fetch: Callable[[str], tuple[int, object]], pause: float = 1.1, wait: float = 2.0, tries: int = 3, sleep: Callable[[float], None] = time.sleep) -> None:
        self.fetch, self.pause, self.wait, self.tries, self.sleep = fetch, pause, wait, tries, sleep
        self.memory: dict[str, object] = {}

    def get(self, url: str) -> object:
        if url in self.memory:
            return self.memory[url]
        for n in range(1, self.tries + 1):
            status, body = self.fetch(url)
            if status != 429:
                break
            self.sleep(self.wait * n)
        if status != 200:
            raise RuntimeError(f"{status} from {url}")
        self.memory[url] = body
        self.sleep(self.pause)
        return body
