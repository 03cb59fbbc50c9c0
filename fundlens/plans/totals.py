"""Registered queries: reconciliation, net positions, axis totals, wide leaves and series."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.functions import exprs as X
from fundlens.operators import pivot as P
from fundlens.operators import reconcile as R
from fundlens.session import read_table as rt

YEARS = tuple(range(2015, 2028))
KEYS = ("category", "initiative")


def _adopted(spark, d):
    cols = ["category", "initiative", "agencies", "amount"]
    a = rt(spark, d, "initiatives").where("fiscal_year <> 2016").select("fiscal_year", *cols)
    b = rt(spark, d, "fy16_schedule_c_initiatives").select(F.lit(2016).alias("fiscal_year"), *cols)
    return a.unionByName(b).withColumn("category", F.upper("category"))


def _awards(spark, d):
    return rt(spark, d, "awards").select("fiscal_year", F.upper("category").alias("category"), "initiative", "amount", "agency")


def _yearly(spark, d):
    return P.matched_itemized(_adopted(spark, d), _awards(spark, d), KEYS)


def reconcile_printed_totals(spark, d):
    """Category sums of the register against totals perturbed for two categories."""
    a = _adopted(spark, d)
    off = F.when(F.col("category") == "ANIMAL CARE", 800).when(F.col("category") == "FOOD ACCESS", -5).otherwise(0)
    printed = a.groupBy("fiscal_year", "category").agg((F.sum("amount") + F.max(off)).cast("bigint").alias("printed"))
    return R.reconcile(a, printed, ["fiscal_year", "category"])


def reconcile_amount_and_count(spark, d):
    """Capital parts and agencies, by amount and by number of projects."""
    c = rt(spark, d, "capital").where("agency <> ''").select("part", "agency", F.col("fy1").alias("amount"))
    printed = c.groupBy("part", "agency").agg(F.sum(F.coalesce("amount", F.lit(0))).cast("bigint").alias("printed"), (F.count(F.lit(1)) + F.max(F.when(F.col("part") == "II", 1).otherwise(0))).alias("projects"))
    return R.reconcile(c, printed, ["part", "agency"], count="projects")


def reconcile_exact_share(spark, d):
    return R.exact_share(reconcile_printed_totals(spark, d))


def reconcile_cross_part(spark, d):
    return R.cross_part(rt(spark, d, "capital"), "part", "II", "III", "fy1")


def transfer_net(spark, d):
    return R.signed_net(rt(spark, d, "transparency").select("resolution", "amount"), "resolution")


def transparency_actions(spark, d):
    t = rt(spark, d, "transparency")
    return t.groupBy("action", F.coalesce(F.col("fiscal_year").cast("string"), F.lit("?")).alias("year")).agg(F.count(F.lit(1)).alias("n"))


def axis_invariance(spark, d):
    return R.axis_totals(_adopted(spark, d), "fiscal_year", ["category", "agencies", "initiative"])


def itemized_vs_adopted(spark, d):
    y = _yearly(spark, d)
    return y.withColumn("clamped", X.clamp_to("itemized", "adopted").cast("bigint"))


def awards_unmatched(spark, d):
    return P.unmatched_awards(_adopted(spark, d), _awards(spark, d), KEYS)


def match_rate_by_year(spark, d):
    return P.match_rate(_adopted(spark, d), _awards(spark, d), KEYS)


def wide_leaf_pivot(spark, d):
    return P.wide_leaves(_yearly(spark, d).where("category <> '' and initiative <> ''"), KEYS, YEARS)


def latest_agency(spark, d):
    a = _adopted(spark, d).where("initiative <> ''")
    y = P.latest_per_key(a, KEYS, "fiscal_year", "agencies", X.agency_bucket("agencies"), "bucket")
    s = a.groupBy(*KEYS, "fiscal_year").agg(F.sum("amount").cast("bigint").alias("latest_amount")).withColumnRenamed("fiscal_year", "latest_year")
    j = y.join(s, [*KEYS, "latest_year"])
    return j.withColumn("description", X.description("initiative", "category", "bucket", "latest_year", "latest_amount"))


def yearly_series_unpivot(spark, d):
    w = P.wide_leaves(_yearly(spark, d).where("category <> '' and initiative <> ''"), KEYS, YEARS)
    long = P.unpivot_years(w, KEYS, "Itemized", YEARS, "itemized")
    return long.groupBy("fiscal_year").agg(F.sum("itemized").cast("bigint").alias("itemized"))


def yearly_series_dense(spark, d):
    return P.series(_adopted(spark, d).where("category <> ''"), (2008, 2027), "category")


def yoy_change(spark, d):
    return P.year_over_year(P.series(_adopted(spark, d).where("category <> ''"), (2010, 2027), "category"), ["category"])


def share_of_max(spark, d):
    g = _yearly(spark, d).where("fiscal_year = 2024").groupBy("category").agg(F.sum("adopted").cast("bigint").alias("adopted"), F.sum("itemized").cast("bigint").alias("itemized"))
    return P.share_of_max(g, ["adopted", "itemized"])


def drilldown_category(spark, d):
    return P.drilldown(_yearly(spark, d), "initiative", 2024, {"category": "FOOD ACCESS"})


def agency_share_external(spark, d):
    """Awards of an agency and year as a share of all capital money of that year."""
    a = _awards(spark, d).where("agency <> ''").groupBy("agency", "fiscal_year").agg(F.sum(F.coalesce("amount", F.lit(0))).cast("bigint").alias("awarded"))
    c = rt(spark, d, "capital").groupBy("fiscal_year").agg(F.sum(F.coalesce("fy1", F.lit(0))).cast("bigint").alias("capital"))
    return a.join(c, "fiscal_year").withColumn("share", F.round(F.try_divide(F.col("awarded").cast("double"), F.col("capital")), 6))


def toplists(spark, d):
    """Ten recipients with most money."""
    return _recipients(spark, d).orderBy(F.desc("total"), "organization").limit(10)


def _recipients(spark, d):
    return rt(spark, d, "awards").where("organization <> ''").groupBy("organization").agg(F.sum(F.coalesce("amount", F.lit(0))).cast("bigint").alias("total"), F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (reconcile_printed_totals, reconcile_amount_and_count, reconcile_exact_share, reconcile_cross_part, transfer_net, transparency_actions, axis_invariance, itemized_vs_adopted, awards_unmatched, match_rate_by_year, wide_leaf_pivot, latest_agency, yearly_series_unpivot, yearly_series_dense, yoy_change, share_of_max, drilldown_category, agency_share_external, toplists)}

_AD = """ad AS (SELECT fiscal_year, upper(category) AS category, initiative, agencies, amount FROM initiatives WHERE fiscal_year <> 2016
  UNION ALL SELECT 2016, upper(category), initiative, agencies, amount FROM fy16_schedule_c_initiatives)"""
_Y = f"""WITH {_AD}, k AS (SELECT category, initiative, fiscal_year, sum(coalesce(amount, 0))::BIGINT AS adopted FROM ad GROUP BY ALL),
w AS (SELECT upper(category) AS category, initiative, fiscal_year, sum(coalesce(amount, 0))::BIGINT AS itemized, count(*) AS n FROM awards GROUP BY ALL),
y AS (SELECT k.*, coalesce(w.itemized, 0) AS itemized FROM k LEFT JOIN w ON w.category = k.category AND w.initiative = k.initiative AND w.fiscal_year = k.fiscal_year)
"""
_REC = f"""WITH {_AD}, s AS (SELECT fiscal_year, category, sum(coalesce(amount, 0))::BIGINT AS parsed, count(*) AS rows, (CASE category WHEN 'ANIMAL CARE' THEN 800 WHEN 'FOOD ACCESS' THEN -5 ELSE 0 END) AS off FROM ad GROUP BY ALL),
r AS (SELECT fiscal_year, category, parsed + off AS printed, parsed, -off AS diff, rows FROM s WHERE category IS NOT NULL),
z AS (SELECT *, CASE WHEN diff = 0 AND printed <> 0 THEN 'OK' ELSE 'DIFF ' || CASE WHEN diff >= 0 THEN '+' ELSE '' END || diff END AS status FROM r)
"""
_WIDE = ", ".join(f"coalesce(sum(adopted) FILTER (WHERE fiscal_year = {y}), 0)::BIGINT AS \"Adopted {y}\", least(coalesce(sum(adopted) FILTER (WHERE fiscal_year = {y}), 0), coalesce(sum(itemized) FILTER (WHERE fiscal_year = {y}), 0))::BIGINT AS \"Itemized {y}\"" for y in YEARS)
_SERIES = "SELECT c.category, CAST(g.y AS INT) AS fiscal_year, coalesce(sum(a.amount), 0)::BIGINT AS total FROM (SELECT DISTINCT category FROM ad WHERE category <> '') c CROSS JOIN generate_series({0}, {1}) AS g(y) LEFT JOIN ad a ON a.category = c.category AND a.fiscal_year = g.y GROUP BY ALL"

ORACLES = {
    "reconcile_printed_totals": _REC + "SELECT * FROM z",
    "reconcile_exact_share": _REC + "SELECT count(*) FILTER (WHERE status = 'OK') AS exact, count(*) AS total FROM z",
    "reconcile_amount_and_count": """WITH s AS (SELECT part, agency, sum(coalesce(fy1, 0))::BIGINT AS parsed, count(*) AS rows FROM capital WHERE agency <> '' AND part IS NOT NULL GROUP BY ALL)
SELECT part, agency, parsed AS printed, parsed, 0::BIGINT AS diff, rows, CASE WHEN part <> 'II' AND parsed <> 0 THEN 'OK' ELSE 'DIFF +0' END AS status FROM s""",
    "reconcile_cross_part": "SELECT coalesce(sum(fy1) FILTER (WHERE part = 'II'), 0)::BIGINT AS left_total, coalesce(sum(fy1) FILTER (WHERE part = 'III'), 0)::BIGINT AS right_total, left_total = right_total AS same FROM capital",
    "transfer_net": "SELECT resolution, sum(greatest(coalesce(amount, 0), 0))::BIGINT AS plus, sum(least(coalesce(amount, 0), 0))::BIGINT AS minus, sum(coalesce(amount, 0))::BIGINT AS net, count(*) AS n, grouping(resolution)::INT AS grand FROM transparency GROUP BY ROLLUP (resolution)",
    "transparency_actions": "SELECT action, coalesce(fiscal_year::VARCHAR, '?') AS year, count(*) AS n FROM transparency GROUP BY ALL",
    "axis_invariance": f"WITH {_AD} " + " UNION ALL ".join(f"SELECT '{a}' AS axis, fiscal_year AS year, sum(coalesce(amount, 0))::BIGINT AS total, count(DISTINCT {a}) + max(CASE WHEN {a} IS NULL THEN 1 ELSE 0 END) AS groups FROM ad GROUP BY fiscal_year" for a in ("category", "agencies", "initiative")),
    "itemized_vs_adopted": _Y + "SELECT *, least(itemized, adopted)::BIGINT AS clamped FROM y",
    "awards_unmatched": _Y + "SELECT category, initiative, fiscal_year, itemized AS amount, n FROM w WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.category = w.category AND k.initiative = w.initiative AND k.fiscal_year = w.fiscal_year)",
    "match_rate_by_year": _Y + ", h AS (SELECT w.*, EXISTS (SELECT 1 FROM k WHERE k.category = w.category AND k.initiative = w.initiative AND k.fiscal_year = w.fiscal_year) AS hit FROM w) SELECT fiscal_year, coalesce(sum(itemized) FILTER (WHERE hit), 0)::BIGINT AS matched, sum(itemized)::BIGINT AS total, round(coalesce(sum(itemized) FILTER (WHERE hit), 0) * 100.0::DOUBLE / nullif(sum(itemized), 0), 6) AS percent FROM h GROUP BY 1",
    "wide_leaf_pivot": _Y + f"SELECT category, initiative, {_WIDE}, row_number() OVER (ORDER BY category, initiative) AS leaf_id FROM y WHERE category <> '' AND initiative <> '' GROUP BY category, initiative",
    "latest_agency": f"""WITH {_AD}, l AS (SELECT category, initiative, max(fiscal_year) AS latest_year FROM ad WHERE initiative <> '' GROUP BY ALL),
b AS (SELECT ad.category, ad.initiative, latest_year, max(coalesce(agencies, '')) AS agencies, sum(amount)::BIGINT AS latest_amount FROM ad JOIN l ON l.category = ad.category AND l.initiative = ad.initiative AND l.latest_year = ad.fiscal_year GROUP BY ALL),
c AS (SELECT category, initiative, latest_year, CASE WHEN trim(agencies) = '' THEN 'Unspecified agency' WHEN agencies LIKE '%,%' THEN 'Multiple agencies' ELSE trim(agencies) END AS bucket, latest_amount FROM b)
SELECT *, '“' || initiative || '” — a ' || category || ' discretionary initiative administered by ' || bucket || '. FY' || latest_year || ' adopted: $' || format('{{:,}}', latest_amount) || '.' AS description FROM c""",
    "yearly_series_unpivot": _Y + ", leaf AS (SELECT category, initiative, fiscal_year, least(adopted, itemized) AS i FROM y WHERE category <> '' AND initiative <> '') SELECT CAST(g.y AS INT) AS fiscal_year, coalesce(sum(i), 0)::BIGINT AS itemized FROM generate_series(2015, 2027) AS g(y) LEFT JOIN leaf ON leaf.fiscal_year = g.y GROUP BY 1",
    "yearly_series_dense": f"WITH {_AD} " + _SERIES.format(2008, 2027),
    "yoy_change": f"WITH {_AD}, s AS ({_SERIES.format(2010, 2027)}), b AS (SELECT *, lag(total) OVER (PARTITION BY category ORDER BY fiscal_year) AS before FROM s), p AS (SELECT *, round(CASE WHEN before <> 0 THEN (total - before) * 100.0::DOUBLE / abs(before) END, 1) AS change_pct FROM b) SELECT *, CASE WHEN change_pct IS NULL THEN NULL ELSE CASE WHEN change_pct < 0 THEN '-' ELSE '+' END || format('{{:,.1f}}', abs(change_pct)) || '%' END AS change FROM p",
    "share_of_max": _Y + ", g AS (SELECT category, sum(adopted)::BIGINT AS adopted, sum(itemized)::BIGINT AS itemized FROM y WHERE fiscal_year = 2024 GROUP BY 1) SELECT *, round(adopted::DOUBLE / nullif((SELECT max(greatest(adopted, itemized)) FROM g), 0), 6) AS share FROM g",
    "drilldown_category": _Y + """, g AS (SELECT initiative, coalesce(sum(adopted) FILTER (WHERE fiscal_year = 2024), 0)::BIGINT AS adopted, coalesce(sum(itemized) FILTER (WHERE fiscal_year = 2024), 0)::BIGINT AS itemized, coalesce(sum(adopted) FILTER (WHERE fiscal_year = 2023), 0)::BIGINT AS before, count(*) FILTER (WHERE fiscal_year = 2024 AND adopted <> 0) AS children FROM y WHERE category = 'FOOD ACCESS' AND fiscal_year IN (2023, 2024) GROUP BY 1),
h AS (SELECT * FROM g WHERE adopted <> 0 OR itemized <> 0) SELECT *, round(CASE WHEN before <> 0 THEN (adopted - before) * 100.0::DOUBLE / abs(before) END, 1) AS change_pct, round(adopted::DOUBLE / nullif((SELECT max(greatest(adopted, itemized)) FROM h), 0), 6) AS share FROM h""",
    "agency_share_external": "WITH a AS (SELECT agency, fiscal_year, sum(coalesce(amount, 0))::BIGINT AS awarded FROM awards WHERE agency <> '' GROUP BY ALL), c AS (SELECT fiscal_year, sum(coalesce(fy1, 0))::BIGINT AS capital FROM capital GROUP BY 1) SELECT a.fiscal_year, agency, awarded, capital, round(awarded::DOUBLE / nullif(capital, 0), 6) AS share FROM a JOIN c USING (fiscal_year)",
    "toplists": "SELECT organization, sum(coalesce(amount, 0))::BIGINT AS total, count(*) AS n FROM awards WHERE organization <> '' GROUP BY 1 ORDER BY total DESC, organization LIMIT 10",
}
