"""Registered queries: cross-year roll-up, canonical names, collisions, modes, overlaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.functions import exprs as X
from fundlens.operators import canonical as C
from fundlens.session import read_table as rt


def _initiatives(spark, d):
    cols = ["fiscal_year", "category", "agencies", "initiative", "amount"]
    return [rt(spark, d, "initiatives").where("fiscal_year <> 2016").select(*cols), rt(spark, d, "fy16_schedule_c_initiatives").select(F.lit(2016).alias("fiscal_year"), *cols[1:])]


def _xw(spark, d):
    return rt(spark, d, "initiative_name_crosswalk"), rt(spark, d, "category_name_crosswalk")


def combined_rollup_union(spark, d):
    return C.combined(_initiatives(spark, d), *_xw(spark, d))


def initiative_canonical_join(spark, d):
    a = rt(spark, d, "awards").select("award_id", "initiative")
    return C.with_canonical_initiative(a, _xw(spark, d)[0], ("approved", "high")).select("award_id", "initiative_canonical")


def category_split_precedence(spark, d):
    a = rt(spark, d, "awards").select("award_id", "category", "initiative")
    return C.with_canonical_category(a, _xw(spark, d)[1]).select("award_id", "category_canonical")


def house_style_text(spark, d):
    x = _xw(spark, d)[0]
    r = "raw_initiative"
    return x.select("raw_id", X.house_style(r).alias("house"), X.norm_mechanical(r).alias("mechanical"), X.norm_aggressive(r).alias("aggressive"))


def category_forms(spark, d):
    r = "raw_category"
    return _xw(spark, d)[1].select("raw_id", X.mech_norm_category(r).alias("mechanical"), X.edit_norm_category(r).alias("editorial"), X.slug(r).alias("slug"))


def _stats(spark, d):
    a, b = _initiatives(spark, d)
    return C.variant_stats(a.unionByName(b), "initiative")


def collision_groups(spark, d):
    return C.collision_groups(_stats(spark, d), X.norm_mechanical("variant"))


def collision_aggressive_only(spark, d):
    return C.aggressive_only(_stats(spark, d), X.norm_mechanical("variant"), X.norm_aggressive("variant"))


def editorial_supergroups(spark, d):
    a, b = _initiatives(spark, d)
    s = C.variant_stats(a.unionByName(b), "category")
    g = C.aggressive_only(s, X.mech_norm_category("variant"), X.edit_norm_category("variant"))
    return g.join(C.dominant_spelling(s, X.edit_norm_category("variant")), "norm")


def dominant_spellings(spark, d):
    a, b = _initiatives(spark, d)
    return C.dominant_spelling(C.variant_stats(a.unionByName(b), "category"), X.mech_norm_category("variant"))


def rename_notes(spark, d):
    x = _xw(spark, d)[0]
    return x.select("raw_id", X.former_name("raw_initiative").alias("former_name")).where("former_name is not null")


def mode_org_per_ein(spark, d):
    a = rt(spark, d, "awards").where("organization <> '' and ein <> ''")
    return C.mode_per_group(a, "ein", "organization", "award_id")


def ein_backfill(spark, d):
    """Organizations missing or written as a purpose are replaced by the usual name of their EIN."""
    a = rt(spark, d, "awards").select("award_id", "ein", "organization")
    bad = (F.coalesce("organization", F.lit("")) == "") | X.is_purpose("organization")
    return C.backfill_by_key(a, "ein", "organization", "award_id", bad).select("award_id", "organization")


def org_overlap(spark, d):
    """Categories by the EINs they share."""
    a = rt(spark, d, "awards").select(F.upper("category").alias("category"), X.norm_ein("ein").alias("ein"))
    return C.set_overlap(a, "category", "ein")


def intersect_except_keys(spark, d):
    """Initiative keys of 2024 that were or were not there in 2023."""
    i = rt(spark, d, "initiatives").select("fiscal_year", F.lower("initiative").alias("initiative"))
    now, before = (i.where(F.col("fiscal_year") == y).select("initiative") for y in (2024, 2023))
    return now.intersect(before).withColumn("side", F.lit("both")).unionByName(now.exceptAll(now.intersect(before)).distinct().withColumn("side", F.lit("new")))


QUERIES = {f.__name__: f for f in (combined_rollup_union, initiative_canonical_join, category_split_precedence, house_style_text, category_forms, collision_groups, collision_aggressive_only, editorial_supergroups, dominant_spellings, rename_notes, mode_org_per_ein, ein_backfill, org_overlap, intersect_except_keys)}

# ------------------------------------------------------------------ SQL

_WS = "[\\s\\p{Z}\\x0B\\x{85}]"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _clean(x: str) -> str:
    return _trim(f"regexp_replace({x}, '{_WS}+', ' ', 'g')")


def house_sql(x: str) -> str:
    s = f"regexp_replace({_trim(f'coalesce({x}, {chr(39)}{chr(39)})')}, '^\\*+{_WS}*', '')"
    s = f"translate({s}, '’‘“”', '''''\"\"')"
    return _clean(f"regexp_replace({s}, '{_WS}*&{_WS}*', ' and ', 'g')")


def mechanical_sql(x: str) -> str:
    return f"trim(lower({house_sql(x)}), '.,;:')"


def aggressive_sql(x: str) -> str:
    s = f"regexp_replace(regexp_replace({mechanical_sql(x)}, '[/-]', ' ', 'g'), '[^a-z0-9 ]', ' ', 'g')"
    stop = ", ".join(f"'{w}'" for w in X.STOP_WORDS)
    return f"array_to_string(list_filter(string_split_regex({s}, ' +'), lambda w: w <> '' AND w NOT IN ({stop})), ' ')"


def mech_category_sql(x: str) -> str:
    s = f"regexp_replace(translate({_trim(f'coalesce({x}, {chr(39)}{chr(39)})')}, '’‘', ''''''), '{_WS}*&{_WS}*', ' and ', 'g')"
    return f"replace(lower({_clean(f'regexp_replace({s}, {chr(39)}[.]+${chr(39)}, {chr(39)}{chr(39)})')}), 'organziations', 'organizations')"


def edit_category_sql(x: str) -> str:
    s = f"regexp_replace({mech_category_sql(x)}, '\\s*\\(formerly[^)]*\\)', '', 'g')"
    s = f"replace(regexp_replace({s}, ',?\\s*formerly .*$', ''), '''s', '')"
    for _ in range(2):
        s = f"trim(regexp_replace({s}, '\\b(services|initiatives|initiative)\\b\\s*$', ''))"
    return _clean(f"regexp_replace({s}, '\\b(\\w{{4,}})s\\b', '\\1', 'g')")


_ALL = """allinit AS (SELECT fiscal_year, category, agencies, initiative, amount FROM initiatives WHERE fiscal_year <> 2016
  UNION ALL SELECT 2016, category, agencies, initiative, amount FROM fy16_schedule_c_initiatives)"""
_IX = "ix AS (SELECT raw_initiative, min(initiative_canonical) AS canon FROM initiative_name_crosswalk WHERE coalesce(initiative_canonical, '') <> '' {0} GROUP BY 1)"
_CX = """cs AS (SELECT raw_category, initiative, min(category_canonical) AS canon FROM category_name_crosswalk WHERE coalesce(category_canonical, '') <> '' AND coalesce(initiative, '') <> '' GROUP BY 1, 2),
cr AS (SELECT raw_category, min(category_canonical) AS canon FROM category_name_crosswalk WHERE coalesce(category_canonical, '') <> '' AND coalesce(initiative, '') = '' GROUP BY 1)"""


def _stats_sql(col: str) -> str:
    return f"stats AS (SELECT {col} AS variant, list_sort(list_distinct(list(fiscal_year))) AS years, sum(coalesce(amount, 0))::BIGINT AS amount, count(*) AS n FROM allinit WHERE {col} <> '' GROUP BY 1)"


def _dominant_sql(norm: str) -> str:
    return f"""dom AS (SELECT norm, variant AS dominant FROM (SELECT {norm} AS norm, variant, row_number() OVER (PARTITION BY {norm} ORDER BY variant = upper(variant), amount DESC, variant) AS r FROM stats) WHERE r = 1),
cas AS (SELECT {norm} AS norm, count(DISTINCT lower(variant)) = 1 AS casing_only FROM stats GROUP BY 1)"""


ORACLES = {
    "combined_rollup_union": f"""WITH {_ALL}, {_IX.format("")}, {_CX}
SELECT a.fiscal_year, a.category, coalesce(cs.canon, cr.canon, a.category) AS category_canonical, a.agencies, a.initiative, coalesce(ix.canon, {house_sql('a.initiative')}) AS initiative_canonical, a.amount
FROM allinit a LEFT JOIN ix ON ix.raw_initiative = a.initiative LEFT JOIN cs ON cs.raw_category = a.category AND cs.initiative = a.initiative LEFT JOIN cr ON cr.raw_category = a.category""",
    "initiative_canonical_join": f"WITH {_IX.format(chr(65) + 'ND confidence IN (' + repr('approved') + ', ' + repr('high') + ')')} SELECT award_id, coalesce(ix.canon, {house_sql('initiative')}) AS initiative_canonical FROM awards LEFT JOIN ix ON ix.raw_initiative = awards.initiative",
    "category_split_precedence": f"WITH {_CX} SELECT award_id, coalesce(cs.canon, cr.canon, a.category) AS category_canonical FROM awards a LEFT JOIN cs ON cs.raw_category = a.category AND cs.initiative = a.initiative LEFT JOIN cr ON cr.raw_category = a.category",
    "house_style_text": f"SELECT raw_id, {house_sql('raw_initiative')} AS house, {mechanical_sql('raw_initiative')} AS mechanical, {aggressive_sql('raw_initiative')} AS aggressive FROM initiative_name_crosswalk",
    "category_forms": f"SELECT raw_id, {mech_category_sql('raw_category')} AS mechanical, {edit_category_sql('raw_category')} AS editorial, replace(regexp_replace(lower(coalesce(raw_category, '')), '[^\\w ]', '', 'g'), ' ', '-') AS slug FROM category_name_crosswalk",
    "collision_groups": f"""WITH {_ALL}, {_stats_sql('initiative')}, s AS (SELECT *, {mechanical_sql('variant')} AS norm FROM stats),
y AS (SELECT norm, max(k) > 1 AS overlap FROM (SELECT norm, y, count(*) AS k FROM (SELECT norm, unnest(years) AS y FROM s) GROUP BY ALL) GROUP BY norm)
SELECT norm, count(*) AS variants, sum(amount)::BIGINT AS amount, sum(n)::BIGINT AS n, any_value(overlap) AS overlap FROM s LEFT JOIN y USING (norm) GROUP BY norm HAVING count(*) > 1""",
    "collision_aggressive_only": f"WITH {_ALL}, {_stats_sql('initiative')} SELECT {aggressive_sql('variant')} AS norm, count(*) AS variants, count(DISTINCT {mechanical_sql('variant')}) AS forms, sum(amount)::BIGINT AS amount FROM stats GROUP BY 1 HAVING count(DISTINCT {mechanical_sql('variant')}) > 1",
    "editorial_supergroups": f"""WITH {_ALL}, {_stats_sql('category')}, g AS (SELECT {edit_category_sql('variant')} AS norm, count(*) AS variants, count(DISTINCT {mech_category_sql('variant')}) AS forms, sum(amount)::BIGINT AS amount FROM stats GROUP BY 1 HAVING count(DISTINCT {mech_category_sql('variant')}) > 1),
{_dominant_sql(edit_category_sql('variant'))} SELECT * FROM g JOIN dom USING (norm) JOIN cas USING (norm)""",
    "dominant_spellings": f"WITH {_ALL}, {_stats_sql('category')}, {_dominant_sql(mech_category_sql('variant'))} SELECT * FROM dom JOIN cas USING (norm)",
    "rename_notes": "SELECT raw_id, trim(regexp_extract(raw_initiative, '(?i)formerly ([^)]+)', 1)) AS former_name FROM initiative_name_crosswalk WHERE trim(regexp_extract(raw_initiative, '(?i)formerly ([^)]+)', 1)) <> ''",
    "mode_org_per_ein": "SELECT ein, organization FROM (SELECT ein, organization, row_number() OVER (PARTITION BY ein ORDER BY count(*) DESC, min(award_id)) AS r FROM awards WHERE organization <> '' AND ein <> '' GROUP BY ein, organization) WHERE r = 1",
    "ein_backfill": f"""WITH b AS (SELECT *, coalesce(organization, '') = '' OR regexp_matches(ltrim(coalesce(organization, '')), '(?i)^(?:funds|funding|finds|(?:fund|find)\\s+(?:{"|".join(X.PURPOSE_VERBS)})\\b)\\b') OR regexp_matches(ltrim(coalesce(organization, '')), '(?i)^(?:{"|".join(X.PURPOSE_LEADS)})') OR regexp_matches(ltrim(coalesce(organization, '')), '^[a-z]') AS bad FROM awards),
m AS (SELECT ein, organization AS usual FROM (SELECT ein, organization, row_number() OVER (PARTITION BY ein ORDER BY count(*) DESC, min(award_id)) AS r FROM b WHERE NOT bad AND ein <> '' GROUP BY ein, organization) WHERE r = 1)
SELECT award_id, CASE WHEN bad THEN coalesce(usual, organization) ELSE organization END AS organization FROM b LEFT JOIN m USING (ein)""",
    "org_overlap": """WITH g AS (SELECT DISTINCT upper(category) AS g, regexp_replace(coalesce(ein, ''), '[^0-9]', '', 'g') AS m FROM awards WHERE category <> '' AND regexp_replace(coalesce(ein, ''), '[^0-9]', '', 'g') <> ''),
z AS (SELECT g, count(*) AS size FROM g GROUP BY 1), s AS (SELECT x.g AS a, y.g AS b, count(*) AS shared FROM g x JOIN g y USING (m) WHERE x.g < y.g GROUP BY ALL)
SELECT a, b, shared, round(shared / least(za.size, zb.size), 6) AS containment, round(shared / (za.size + zb.size - shared), 6) AS jaccard FROM s JOIN z za ON za.g = a JOIN z zb ON zb.g = b""",
    "intersect_except_keys": """WITH n AS (SELECT lower(initiative) AS initiative FROM initiatives WHERE fiscal_year = 2024), p AS (SELECT lower(initiative) AS initiative FROM initiatives WHERE fiscal_year = 2023)
SELECT initiative, 'both' AS side FROM (SELECT * FROM n INTERSECT SELECT * FROM p) UNION ALL SELECT initiative, 'new' FROM (SELECT * FROM n EXCEPT SELECT * FROM p)""",
}
