"""Registered queries of sources and sinks: whole tables written to the shared folder and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.session import read_table as rt
from fundlens.session import shared_folder
from fundlens.sources import readers as R
from fundlens.sources import sinks as S

_AWARD = ("award_id", "category", "initiative", "organization", "program", "ein", "amount", "purpose")
_CAPITAL = ("project_id", "agency", "title", "fy1")


def _folder(spark) -> str:
    return f"{shared_folder(spark.sparkContext).rstrip('/')}/round-trip-{uuid.uuid4().hex}"


def csv_strict_round_trip(spark, d):
    p = _folder(spark)
    S.write_csv(rt(spark, d, "awards"), p, _AWARD)
    return R.read_csv_strict(spark, p, _AWARD)


def csv_lenient_round_trip(spark, d):
    """Carriage returns end the records of this file; absent columns come back empty. Titles hold line breaks: a record may take several lines."""
    p = _folder(spark)
    S.write_csv(rt(spark, d, "capital").select("project_id", "agency", "title"), p, _CAPITAL, single=True, crlf=True)
    return R.read_csv_lenient(spark, p, _CAPITAL)


def json_round_trip(spark, d):
    p = _folder(spark)
    S.write_json(rt(spark, d, "terms").select("term_id", "agency_name", "num_units"), p)
    return spark.read.schema("term_id bigint, agency_name string, num_units int").json(p)


def table_round_trip(spark, d):
    """Partitioned by year, sorted within files, opened again by name."""
    p = _folder(spark)
    t = rt(spark, d, "transparency").select("action_id", "source_fy", "amount")
    n = S.write_table(t, f"{p}/actions.parquet", "source_fy", "action_id", rows_per_file=5_000)
    back = R.open_tables(spark, p, ["actions"])["actions"]
    return back.groupBy("source_fy").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("bigint").alias("amount")).withColumn("written", F.lit(n).cast("bigint"))


def years_of_folders(spark, d):
    """One file a year, the year told by the folder."""
    p = _folder(spark)
    a = rt(spark, d, "awards").select("award_id", "fiscal_year", "amount")
    for y in (2023, 2024):
        S.write_csv(a.where(F.col("fiscal_year") == y), f"{p}/fy{y % 100}/awards", ("award_id", "amount"))
    whole = R.read_years(spark, f"{p}/*/awards/*.csv", ("award_id", "amount"), multi_line=False)
    listed = R.read_year_list(lambda y: a.where(F.col("fiscal_year") == y).drop("fiscal_year"), (2023, 2024))
    one = whole.groupBy("year", "fiscal_year").agg(F.count(F.lit(1)).alias("rows"))
    return one.join(listed.groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("listed")), "fiscal_year")


def tree_of_files(spark, d):
    """Files of a tree by what their names say; files of no known name are passed over."""
    p = _folder(spark)
    names = ("fy24_schedule_c_awards.csv", "fy24_capital_projects.csv", "legistar_crosswalk.csv", "reso12_transparency_designations.csv", "notes.csv")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for n in names:
        out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{p}/fy24/{n}"), True)
        out.write(bytearray(b'a,b\n1,"x, y"\n2,\n'))
        out.close()
    found = R.read_tree(spark, p, {t: ("a", "b") for t in ("schedule_c_awards", "capital", "transparency_reso")})
    parts = [df.select(F.lit(t).alias("type"), "a", "b") for t, df in sorted(found.items())]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def optional_files(spark, d):
    schema = T.StructType([T.StructField("region", T.StringType())])
    there, yes = R.optional(spark, f"{d}/region.parquet", schema, lambda p: spark.read.parquet(p).select(F.col("r_name").alias("region")))
    gone, no = R.optional(spark, f"{d}/nowhere.parquet", schema, spark.read.parquet)
    return there.unionByName(gone).withColumns({"found": F.lit(yes), "missing": F.lit(not no)})


def rows_to_do(spark, d):
    """What a resumed run has left: awards of the years that are not done."""
    a = rt(spark, d, "awards").select("award_id", "fiscal_year")
    return S.todo(a, a.where("fiscal_year < 2024"), ["award_id"])


def build_metadata(spark, d):
    return spark.createDataFrame(S.metadata("tables", {"awards": [2023, 2024]}, {"awards": 5, "terms": 2}), "key string, value string")


def resolutions_in_order(spark, d):
    """Resolution documents by their number; those marked as duplicates are left out."""
    p = _folder(spark)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for n in ("Transparency-Reso-02-2025-08-14.pdf", "Transparency-Reso-10-2026-01-29.pdf", "Transparency-Reso-02-2025-08-14-dup.pdf", "other.pdf"):
        fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{p}/{n}"), True).close()
    return R.resolution_files(spark, p).select("seq", "date")


def service_answers(spark, d):
    """A service that refuses twice, answers, and is asked once for what it has told before."""
    asked, waits = [], []
    replies = iter([(429, None), (429, None), (200, [{"id": 1}]), (200, [{"id": 2}])])
    s = R.Service(lambda url: (asked.append(url), next(replies))[1], sleep=waits.append)
    rows = [(u, s.get(u)[0]["id"]) for u in ("/a", "/b", "/a")]
    return spark.createDataFrame([(i, u, n, len(asked), round(sum(waits), 1)) for i, (u, n) in enumerate(rows)], "n int, url string, id int, calls int, waited double")


QUERIES = {f.__name__: f for f in (csv_strict_round_trip, csv_lenient_round_trip, json_round_trip, table_round_trip, years_of_folders, tree_of_files, optional_files, rows_to_do, build_metadata, resolutions_in_order, service_answers)}

_TRIM = "regexp_replace(coalesce({0}::VARCHAR, ''), '^[\\s\\p{{Z}}\\x0B\\x{{85}}]+|[\\s\\p{{Z}}\\x0B\\x{{85}}]+$', '', 'g')"
ORACLES = {
    "csv_strict_round_trip": f"SELECT {', '.join(_TRIM.format(c) + ' AS ' + c for c in _AWARD)} FROM awards",
    "csv_lenient_round_trip": "SELECT project_id::VARCHAR AS project_id, coalesce(agency, '') AS agency, coalesce(title, '') AS title, '' AS fy1, NULL AS _corrupt FROM capital",
    "json_round_trip": "SELECT term_id, agency_name, num_units FROM terms",
    "table_round_trip": "SELECT source_fy, count(*) AS rows, sum(amount)::BIGINT AS amount, (SELECT count(*) FROM transparency) AS written FROM transparency GROUP BY 1",
    "years_of_folders": "SELECT fiscal_year, 'FY' || (fiscal_year % 100) AS year, count(*) AS rows, count(*) AS listed FROM awards WHERE fiscal_year IN (2023, 2024) GROUP BY 1, 2",
    "tree_of_files": "SELECT t AS type, a, b FROM (VALUES ('schedule_c_awards'), ('capital'), ('transparency_reso')) n(t) CROSS JOIN (VALUES ('1', 'x, y'), ('2', '')) c(a, b)",
    "optional_files": "SELECT r_name AS region, true AS found, true AS missing FROM region",
    "rows_to_do": "SELECT award_id, fiscal_year FROM awards WHERE fiscal_year >= 2024 OR fiscal_year IS NULL",
    "build_metadata": """SELECT * FROM (VALUES ('source', 'tables'), ('parsed_fiscal_years', '{"awards": [2023, 2024]}'), ('counts', '{"awards": 5, "terms": 2}')) t(key, value)""",
    "resolutions_in_order": "SELECT * FROM (VALUES (2, '2025-08-14'), (10, '2026-01-29')) t(seq, date)",
    "service_answers": "SELECT * FROM (VALUES (0, '/a', 1, 4, 8.2), (1, '/b', 2, 4, 8.2), (2, '/a', 1, 4, 8.2)) t(n, url, id, calls, waited)",
}
