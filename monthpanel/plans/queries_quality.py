"""Registered queries: quality tables, target catalog, table profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthpanel.operators.panel import month_spine
from monthpanel.operators.quality import (
    column_coverage, correlations_with_target, describe_series, latest_values, missing_pct,
)
from monthpanel.operators.targets import available_targets, label_columns
from monthpanel.plans.sheets import csv_files, numbered_book
from monthpanel.plans.views import SUPPLIER_MONTH, rounded, supplier_month, supplier_spine_sql, table
from monthpanel.sources.profile import candidate_listing, profile_folder, profile_sheets, sniff_delimiters
from monthpanel.sources.tables import new_folder

KEYS = ["supplier"]
# Tasks that write files, for each core.
WRITERS = 4
DESCRIBED = {"mean": 5, "std": 3, "q25": 4, "q50": 4, "q75": 4}


def describe_series_query(spark, sf_dir):
    return rounded(describe_series(supplier_month(spark, sf_dir), "revenue", KEYS, monthly=True), **DESCRIBED)


def describe_values(spark, sf_dir):
    """Raw rows, three groups: quartiles of groups that hold a third of the table each."""
    return rounded(describe_series(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"]), **DESCRIBED)


def missing_pct_query(spark, sf_dir):
    spine = month_spine(supplier_month(spark, sf_dir).drop("discount"), keys=KEYS)
    return rounded(missing_pct(spine), missing_pct=8)


def corr_with_target(spark, sf_dir):
    months = supplier_month(spark, sf_dir).select("supplier", "date", "quantity", "steady", "discount", "lines")
    made = correlations_with_target(months, "quantity", KEYS, 2)
    return rounded(made, correlation_with_target=8)


def column_coverage_query(spark, sf_dir):
    return column_coverage(supplier_month(spark, sf_dir), ["quantity", "steady"], KEYS)


def target_catalog_query(spark, sf_dir):
    months = supplier_month(spark, sf_dir).select(
        "supplier", "date", F.col("quantity").alias("construction_area_m2"),
        F.col("steady").alias("imae_general_index"), F.col("revenue").alias("not_listed_yet"),
    )
    known = available_targets(months, KEYS, 60).drop("description")
    return known


def series_labels(spark, sf_dir):
    months = supplier_month(spark, sf_dir).select(
        "supplier", "date", F.col("quantity").alias("construction_area_m2"), F.col("revenue").alias("not_listed_yet"))
    return label_columns(column_coverage(months, ["construction_area_m2", "not_listed_yet"], KEYS))


def latest_values_query(spark, sf_dir):
    return latest_values(supplier_month(spark, sf_dir), "steady", 12, KEYS)


def table_profile(spark, sf_dir):
    return candidate_listing(profile_sheets(numbered_book(supplier_month(spark, sf_dir))))


def delimiter_sniff(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("path"), "text")
    files = documents.unionByName(csv_files(supplier_month(spark, sf_dir)))
    return candidate_listing(sniff_delimiters(files))


def folder_profile(spark, sf_dir):
    """The suppliers' text files, written to folders and profiled from there."""
    folder = new_folder(spark, "files")
    # A file costs far more than its few bytes, by which adaptive execution would choose the number of tasks.
    files = csv_files(supplier_month(spark, sf_dir)).withColumnRenamed("path", "of").repartition(WRITERS * spark.sparkContext.defaultParallelism, "of")
    files.write.partitionBy("of").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)
    found = candidate_listing(profile_folder(spark, folder, recursive=True))
    return found.withColumn("path", F.regexp_extract("path", "of=([^/]*)/", 1))


def _describe_sql(source, key, value):
    return f"""
SELECT {key}, count({value}) AS count, round(avg({value}), 5) AS mean, round(stddev_samp({value}), 3) AS std,
       min({value}) AS min, round(quantile_cont({value}, 0.25), 4) AS q25, round(quantile_cont({value}, 0.5), 4) AS q50,
       round(quantile_cont({value}, 0.75), 4) AS q75, max({value}) AS max
FROM {source} GROUP BY 1"""


_NUMBER = r"""TRY_CAST(CASE
  WHEN regexp_matches(d, '\..*,[^.]*$') OR regexp_matches(d, '^[^.]*,[^.,]{1,2}$') THEN replace(replace(d, '.', ''), ',', '.')
  ELSE replace(d, ',', '') END AS DOUBLE)"""
_MISSING = """('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A',
  'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"""

QUERIES = {
    "describe_series": (describe_series_query,
                        f"WITH {SUPPLIER_MONTH}" + _describe_sql("supplier_month", "supplier", "revenue")),
    "describe_values": (describe_values, _describe_sql("lineitem", "l_returnflag", "l_extendedprice")),
    "missing_pct": (missing_pct_query, f"""
WITH {SUPPLIER_MONTH}, {supplier_spine_sql('quantity')},
full_spine AS (SELECT s.supplier, s.date, m.quantity, m.revenue, m.lines, m.steady
               FROM spine s LEFT JOIN supplier_month m USING (supplier, date)),
shares AS (SELECT 0.0::DOUBLE AS supplier, 0.0::DOUBLE AS date, 100.0 * avg((quantity IS NULL)::INT) AS quantity,
             100.0 * avg((revenue IS NULL)::INT) AS revenue, 100.0 * avg((lines IS NULL)::INT) AS lines,
             100.0 * avg((steady IS NULL)::INT) AS steady FROM full_spine),
long AS (UNPIVOT shares ON supplier, date, quantity, revenue, lines, steady INTO NAME "column" VALUE v)
SELECT "column", round(v, 8) AS missing_pct FROM long"""),
    "corr_with_target": (corr_with_target, f"""
WITH {SUPPLIER_MONTH},
wide AS (SELECT supplier, corr(steady, quantity) AS steady, corr(discount, quantity) AS discount,
           corr(lines, quantity) AS lines FROM supplier_month GROUP BY 1),
long AS (UNPIVOT wide ON steady, discount, lines INTO NAME feature VALUE c)
SELECT supplier, feature, round(c, 8) AS correlation_with_target FROM long
QUALIFY row_number() OVER (PARTITION BY supplier ORDER BY abs(c) DESC, feature) <= 2"""),
    "column_coverage": (column_coverage_query, f"""
WITH {SUPPLIER_MONTH}
SELECT supplier, 'quantity' AS "column", count(quantity) AS observations, min(date) AS first_date, max(date) AS last_date
FROM supplier_month GROUP BY 1 UNION ALL
SELECT supplier, 'steady', count(steady), min(date) FILTER (WHERE steady IS NOT NULL),
       max(date) FILTER (WHERE steady IS NOT NULL) FROM supplier_month GROUP BY 1"""),
    "target_catalog": (target_catalog_query, f"""
WITH {SUPPLIER_MONTH}, counts AS (
  SELECT supplier, 'construction_area_m2' AS "column", 'Construction area' AS label, 'square meters' AS unit,
         50 AS priority, count(quantity) AS observations FROM supplier_month GROUP BY 1 UNION ALL
  SELECT supplier, 'imae_general_index', 'IMAE general index', 'index', 31, count(steady) FROM supplier_month GROUP BY 1)
SELECT * FROM counts WHERE observations >= 60"""),
    "series_labels": (series_labels, f"""
WITH {SUPPLIER_MONTH}
SELECT supplier, c AS "column", l AS label, count(*) AS observations, min(date) AS first_date, max(date) AS last_date
FROM supplier_month, (VALUES ('construction_area_m2', 'Construction area'), ('not_listed_yet', 'Not Listed Yet')) v(c, l)
GROUP BY 1, 2, 3"""),
    "latest_values": (latest_values_query, f"""
WITH {SUPPLIER_MONTH} SELECT supplier, date, steady FROM supplier_month WHERE steady IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY supplier ORDER BY date DESC) <= 12"""),
    "table_profile": (table_profile, f"""
WITH {SUPPLIER_MONTH},
placed AS (
  SELECT supplier, row_number() OVER (PARTITION BY supplier ORDER BY date) AS pos, count(*) OVER (PARTITION BY supplier) AS n,
    lower(['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre', 'Octubre', 'Noviembre',
           'Diciembre'][month(date)]) AS mes, CAST(CAST(quantity AS BIGINT) AS VARCHAR) AS q, CAST(lines AS VARCHAR) AS l
  FROM supplier_month),
heads AS (
  SELECT DISTINCT supplier, 0 AS pos, n, 'mes' AS mes, 'cantidad' AS q, 'lineas' AS l FROM placed UNION ALL
  SELECT supplier, pos, n, mes, q, CASE WHEN q = l THEN l || '_1' ELSE l END FROM placed WHERE pos <= 11)
SELECT CAST(supplier AS VARCHAR) AS path, 'Hoja1' AS sheet, CAST(pos AS INT) AS header_row, CAST(least(80, n - pos) AS BIGINT) AS rows,
       CAST(3 AS BIGINT) AS columns, mes || ', ' || q || ', ' || l AS column_names,
       CASE WHEN pos = 0 THEN 'mes' ELSE '' END AS date_like_columns, q || ', ' || l AS numeric_like_columns
FROM heads WHERE pos < n"""),
    "delimiter_sniff": (delimiter_sniff, f"""
WITH {SUPPLIER_MONTH},
books AS (
  SELECT supplier, string_agg(strftime(date, '%Y-%m') || '~' || CAST(quantity AS BIGINT) || '~"' || lines || ' ~ lotes"',
                              chr(10) ORDER BY date) AS body FROM supplier_month GROUP BY 1),
files AS (
  SELECT 'doc-' || doc_id AS path, text FROM documents UNION ALL
  SELECT 'sup-' || supplier, replace('Mes~Cantidad~Líneas' || chr(10) || body, '~', [';', chr(9), '|'][supplier % 3 + 1]) FROM books),
tried AS (
  SELECT path, attempt, mark, chr(10) || text AS text, '[' || mark || chr(10) || ']"[^"]*(?:""[^"]*)*"' AS quoted
  FROM files, (VALUES (0, ','), (1, ';'), (2, chr(9)), (3, '|')) a(attempt, mark)),
shielded AS (
  SELECT path, attempt, mark, array_to_string(list_transform(string_split_regex(text, quoted), lambda p, i:
    p || coalesce((list_transform(regexp_extract_all(text, quoted), lambda q: q[1] || translate(q[2:],
      ',;' || chr(9) || '|' || chr(10), chr(1) || chr(2) || chr(3) || chr(4) || chr(5))))[i], '')), '') AS t
  FROM tried),
tries AS (
  SELECT path, attempt, mark, list_transform(list_filter(string_split(t, chr(10)),
    lambda x: trim(x, CASE mark WHEN chr(9) THEN ' ' ELSE ' ' || chr(9) END) <> '')[1:81], lambda x: string_split(x, mark)) AS f FROM shielded),
indexed AS (SELECT path, attempt, mark, f, greatest(0, len(f[2]) - len(f[1])) AS e FROM tries WHERE len(f) > 1 AND len(f[1]) >= 2),
shaped AS (
  SELECT path, attempt, mark, f[1] AS h, len(f[1]) AS w,
    list_filter(list_transform(f[2:81], lambda r: r[e + 1:]), lambda r: len(list_filter(r, lambda v: v NOT IN {_MISSING})) > 0) AS body
  FROM indexed WHERE list_max(list_transform(f[2:81], lambda r: len(r))) <= len(f[1]) + e),
columns AS (SELECT path, attempt, mark, len(body) AS n, unnest(h) AS label, unnest(range(1, w + 1)) AS col FROM shaped WHERE len(body) > 0),
fields AS (SELECT path, attempt, unnest(body) AS r FROM shaped),
vals AS (
  SELECT path, attempt, CASE WHEN v[1] = '"' THEN trim(v, '"') ELSE v END AS v, col FROM (
  SELECT path, attempt, translate(v, chr(1) || chr(2) || chr(3) || chr(4) || chr(5), ',;' || chr(9) || '|' || chr(10)) AS v, col
  FROM (SELECT path, attempt, unnest(r) AS v, unnest(range(1, len(r) + 1)) AS col FROM fields))),
digits AS (SELECT *, regexp_replace(v, '[^0-9,.\\-]', '', 'g') AS d FROM vals WHERE v NOT IN {_MISSING}),
counted AS (SELECT path, attempt, col, count({_NUMBER}) AS numbers FROM digits GROUP BY 1, 2, 3),
named AS (
  SELECT c.*, numbers, CASE WHEN trim(label) = '' THEN 'unnamed_' || (col - 1) ELSE coalesce(nullif(trim(regexp_replace(
      regexp_replace(strip_accents(lower(label)), '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unnamed') END AS slug,
    row_number() OVER (PARTITION BY path, attempt, label ORDER BY col) - 1 AS k
  FROM columns c JOIN counted USING (path, attempt, col)),
final AS (SELECT *, CASE WHEN k > 0 THEN slug || '_' || k ELSE slug END AS name FROM named),
tables AS (
  SELECT path, attempt, mark AS delimiter, n AS rows, count(*) AS columns, list(name ORDER BY col) AS names,
    coalesce(list(name ORDER BY col) FILTER (WHERE regexp_matches(name, 'fecha|date|ano|anio|year|mes|month|periodo')), []) AS dates,
    coalesce(list(name ORDER BY col) FILTER (WHERE numbers * 2 >= n), []) AS numbers
  FROM final GROUP BY ALL)
SELECT path, delimiter, CAST(rows AS BIGINT) AS rows, columns, array_to_string(names[1:20], ', ') AS column_names,
       array_to_string(dates, ', ') AS date_like_columns, array_to_string(numbers[1:20], ', ') AS numeric_like_columns
FROM tables WHERE columns >= 2 AND (len(dates) > 0 OR len(numbers) >= 2)
QUALIFY row_number() OVER (PARTITION BY path ORDER BY attempt) = 1"""),
}

# The same rules for the suppliers' files alone, in the columns of a folder's profile.
QUERIES["folder_profile"] = (folder_profile, QUERIES["delimiter_sniff"][1].replace(
    "SELECT 'doc-' || doc_id AS path, text FROM documents UNION ALL\n  SELECT 'sup-' || supplier,", "SELECT 'sup-' || supplier AS path,"
).replace("'~', [';', chr(9), '|'][supplier % 3 + 1])", "'~', [';', chr(9), '|'][supplier % 3 + 1]) AS text").replace(
    "SELECT path, delimiter, CAST(rows", "SELECT path, 'csv' AS sheet, 0 AS header_row, CAST(rows"))
