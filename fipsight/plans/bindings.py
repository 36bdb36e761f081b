"""Every operator bound to the TPC-H-like test tables, with its DuckDB oracle SQL.

Stand-ins (the real inputs are county files; the tests use the generic tables):
county <- nation key, day <- order date, AQI reading <- order price, death rate <- shipped
quantity per supplier nation, pollutant <- order priority, accident <- order, person <- line
item, monitor/event file <- events. Money is aggregated as integer cents and divided once at the
end so both engines produce the same doubles; statistics are rounded to 6 decimals and
money-scale means to 4, where float summation order could otherwise show.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fipsight.functions import (composite_id, day_of_year0, fips_from_float_text,
                                fips_from_parts, hours_between, pad_min, parse_timestamp,
                                response_minutes, safe_double, year_of_id)
from fipsight.functions.casts import try_typed
from fipsight.operators import rollup, series, stats
from fipsight.operators.frequent import chosen_histograms, feature_screen
from fipsight.operators.lookup import fips_lookup
from fipsight.operators.moments import pattern_moments
from fipsight.operators.project import (exclude_label, feature_prep, min_length, numeric_where,
                                        select_keep)
from fipsight.operators.profile import (feature_histogram, frequency_screen, keep_selected,
                                        unpivot_features)
from fipsight.session import ensure_checkpoint_dir
from fipsight.sources.drift import header_census, header_map, read_drifting
from fipsight.sources.files import read_csv, read_series_text, with_path_token, write_single_csv
from fipsight.sources.json_flat import flatten_json
from fipsight.sources.tuple_text import parse_tuple_text
from fipsight.sources.yearly import column_presence, merge_years

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(c: str = "o_totalprice"):
    return F.round(F.col(c) * 100).cast("bigint")


SQL_CENTS = "cast(round(o_totalprice * 100) AS bigint)"


def rnd(c, digits: int):
    """Half-up rounding written as floor(x * 10^d + 0.5) / 10^d: the same IEEE steps in Spark
    and DuckDB (their round() functions treat decimal ties differently)."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def R(expr: str, digits: int) -> str:
    scale = f"{float(10 ** digits)!r}::double"
    return f"(floor(({expr}) * {scale} + 0.5) / {scale})"

# ---------------------------------------------------------------------------------------------
# shared stand-in chains
# ---------------------------------------------------------------------------------------------


def priced_orders(spark, d, extra=()):
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", *extra,
                                         _cents().alias("cents"))
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return o.join(c, o.o_custkey == c.c_custkey, "inner")


def nation_daily(spark, d, keys=("n_nationkey",), extra=()):
    dm = rollup.daily_mean(priced_orders(spark, d, extra), list(keys), "o_orderdate", "cents",
                           out="mean_cents")
    mean = F.col("mean_cents") / 100
    return dm.select(*keys, "dt", mean.alias("mean_price"), "n_readings",
                     F.floor(mean * F.lit(1e6) + F.lit(0.5)).alias("micro"))


SQL_DAILY = f"""
SELECT c_nationkey AS n_nationkey, cast(o_orderdate AS date) AS dt,
       sum({SQL_CENTS})::double / count(*) / 100 AS mean_price, count(*) AS n_readings
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2"""
SQL_DAILY_MICRO = f"""
SELECT *, cast(floor(mean_price * 1e6 + 0.5) AS bigint) AS micro FROM ({SQL_DAILY})"""


def month_of(c):
    return (F.year(c) * 100 + F.month(c)).cast("int")


def sql_month(c):
    return f"cast(year({c}) * 100 + month({c}) AS integer)"


def nation_month_exposure(spark, d, keys=("n_nationkey",), extra=()):
    # mean of daily means over exact integer micro-units, divided once at the end
    daily = nation_daily(spark, d, keys, extra)
    m = rollup.yearly_mean(daily, list(keys), value="micro", out="x_micro",
                           period="period", period_of=month_of(F.col("dt")))
    return m.select(*keys, "period", (F.col("x_micro") / F.lit(1e6)).alias("x"), "n_days")


def nation_month_outcome(spark, d):
    li = table(spark, d, "lineitem")
    # pre-aggregate line items per (supplier, month) before the join: the shuffle carries
    # one row per supplier-month instead of one per line item
    per_supp = li.groupBy("l_suppkey", month_of(F.col("l_shipdate")).alias("period")) \
                 .agg(F.sum("l_quantity").alias("q"))
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    j = per_supp.join(s, per_supp.l_suppkey == s.s_suppkey, "inner")
    return j.groupBy("n_nationkey", "period").agg(F.sum("q").alias("y"))


SQL_PAIRS = f"""
WITH d AS (
  SELECT c_nationkey AS k, cast(o_orderdate AS date) AS dt,
         sum({SQL_CENTS})::double / count(*) / 100 AS m
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
x AS (SELECT k, {sql_month('dt')} AS period,
      sum(cast(floor(m * 1e6 + 0.5) AS bigint))::double / count(*) / 1e6 AS x
      FROM d GROUP BY 1, 2),
y AS (SELECT s_nationkey AS k, {sql_month('l_shipdate')} AS period, sum(l_quantity) AS y
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
p AS (SELECT x.k, x.period, x.x, y.y FROM x LEFT JOIN y USING (k, period)
      WHERE x.k IN (SELECT k FROM y)),
v AS (SELECT *, (x IS NOT NULL AND NOT isnan(x) AND y IS NOT NULL AND y <> 0) AS ok FROM p)"""


SQL_CORR = """covar_pop(CASE WHEN ok THEN x END, CASE WHEN ok THEN y END) /
  nullif(stddev_pop(CASE WHEN ok THEN x END) * stddev_pop(CASE WHEN ok THEN y END), 0)"""


def nation_pairs(spark, d):
    return rollup.paired_series(nation_month_exposure(spark, d), nation_month_outcome(spark, d),
                                "n_nationkey", "period", "x", "y")


# ---------------------------------------------------------------------------------------------
# 2.1 / 2.2 / 2.3 scans, projections, filters
# ---------------------------------------------------------------------------------------------


@query("scan_project", """
SELECT c_custkey, c_name, c_mktsegment, cast(NULL AS varchar) AS c_phone FROM customer""")
def q_scan_project(spark, d):
    return select_keep(table(spark, d, "customer"), ["c_custkey", "c_name", "c_mktsegment",
                                                     "c_phone"])


@query("filter_label", """
SELECT c_custkey, c_mktsegment, cast(c_custkey AS varchar) AS key_text FROM customer
WHERE c_mktsegment IS DISTINCT FROM 'BUILDING' AND length(cast(c_custkey AS varchar)) > 2""")
def q_filter_label(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment",
                                           F.col("c_custkey").cast("string").alias("key_text"))
    return min_length(exclude_label(c, "c_mktsegment", "BUILDING"), "key_text", 2)


@query("filter_numeric", """
SELECT event_id, user_id, try_cast(json_extract_string(props, '$.k') AS double) AS k
FROM events
WHERE event_type = 'click' AND try_cast(json_extract_string(props, '$.k') AS double) IS NOT NULL
  AND isfinite(try_cast(json_extract_string(props, '$.k') AS double))""")
def q_filter_numeric(spark, d):
    e = table(spark, d, "events").withColumn("k_text", F.get_json_object("props", "$.k"))
    return numeric_where(e, F.col("event_type") == "click", "k_text") \
        .select("event_id", "user_id", safe_double("k_text").alias("k"))


@query("safe_cast", """
SELECT event_id, cast(user_id AS varchar) AS user_text,
       try_cast(json_extract_string(props, '$.k') AS bigint) AS k_text, event_type
FROM events""")
def q_safe_cast(spark, d):
    e = table(spark, d, "events").select(
        "event_id", F.col("user_id").cast("string").alias("user_text"),
        F.get_json_object("props", "$.k").alias("k_text"), "event_type")
    return try_typed(e, keep_text=["user_text"])


# ---------------------------------------------------------------------------------------------
# 2.8 strings / keys
# ---------------------------------------------------------------------------------------------


@query("fips_build", """
WITH t AS (SELECT c_custkey, c_mktsegment, cast(c_nationkey AS varchar) AS s,
                  cast(c_custkey AS varchar) AS c,
                  cast(cast(c_custkey AS double) AS varchar) AS f FROM customer),
u AS (SELECT *, CASE WHEN length(s) < 2 THEN lpad(s, 2, '0') ELSE s END AS state,
             CASE WHEN length(c) < 3 THEN lpad(c, 3, '0') ELSE c END AS county,
             cast(cast(try_cast(f AS double) AS bigint) AS varchar) AS fi FROM t)
SELECT c_custkey, state, county, state || county AS fips,
       CASE WHEN length(fi) = 4 THEN '0' || fi ELSE fi END AS fips_float,
       concat_ws(',', state || county, c_mktsegment) AS line
FROM u""")
def q_fips_build(spark, d):
    c = table(spark, d, "customer")
    fips = fips_from_parts("c_nationkey", "c_custkey")
    out = c.select("c_custkey", "c_mktsegment", pad_min("c_nationkey", 2).alias("state"),
                   pad_min("c_custkey", 3).alias("county"), fips.alias("fips"),
                   F.col("c_custkey").cast("double").cast("string").alias("_f"))
    return out.select("c_custkey", "state", "county", "fips",
                      fips_from_float_text("_f").alias("fips_float"),
                      F.concat_ws(",", "fips", "c_mktsegment").alias("line"))


@query("composite_id", """
SELECT o_orderkey, cast(year(o_orderdate) AS integer) AS year,
       cast(o_orderkey AS varchar) || cast(year(o_orderdate) AS varchar) AS id,
       try_cast(right(cast(o_orderkey AS varchar) || cast(year(o_orderdate) AS varchar), 4)
                AS integer) AS id_year
FROM orders""")
def q_composite_id(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    o = o.withColumn("id", composite_id("o_orderkey", "year"))
    return o.withColumn("id_year", year_of_id("id"))


# ---------------------------------------------------------------------------------------------
# 2.1 sources
# ---------------------------------------------------------------------------------------------


@query("tuple_text_parse", f"""
WITH t AS (
  SELECT '(''' || o_orderkey || '.0'', ''' || o_orderstatus || ''', '''
         || year(o_orderdate) || ''', ''' || {SQL_CENTS} || ''')' AS value FROM orders),
p AS (SELECT string_split(translate(value, '''() ', ''), ',') AS parts FROM t)
SELECT split_part(parts[1], '.', 1) AS key, parts[2] AS status,
       try_cast(parts[3] AS integer) AS year, try_cast(parts[4] AS bigint) / 100 AS amount
FROM p""")
def q_tuple_text_parse(spark, d):
    o = table(spark, d, "orders")
    text = o.select(F.concat(F.lit("('"), F.col("o_orderkey").cast("string"), F.lit(".0', '"),
                             F.col("o_orderstatus"), F.lit("', '"),
                             F.year("o_orderdate").cast("string"), F.lit("', '"),
                             _cents().cast("string"), F.lit("')")).alias("value"))
    p = parse_tuple_text(text, [("key", "string"), ("status", "string"), ("year", "int"),
                                ("cents", "bigint")], cut_at_dot=["key"])
    return p.select("key", "status", "year", (F.col("cents") / 100).alias("amount"))


@query("json_flatten", """
SELECT event_id, try_cast(json_extract(props, '$.k') AS bigint) AS "@k" FROM events""")
def q_json_flatten(spark, d):
    return flatten_json(table(spark, d, "events"), "props", keep=["event_id"])


@query("json_flatten_nested", """
SELECT l_orderkey AS id, l_orderkey AS "@key", l_linenumber::bigint AS "@line@no", cast(l_quantity AS bigint) AS "@line@deep@qty",
       l_returnflag AS "@flags0", CASE WHEN l_linenumber > 2 THEN l_linestatus END AS "@flags1",
       CASE WHEN l_linenumber % 3 = 0 THEN cast(l_suppkey AS varchar) WHEN l_linenumber % 3 = 1 THEN 'none' END AS "@mixed",
       CASE WHEN l_linenumber % 3 = 2 THEN l_suppkey END AS "@mixed@in"
FROM lineitem""")
def q_json_flatten_nested(spark, d):
    """Documents with a record path, nested objects, arrays of differing length, and a member that is a number,
    a text or an object; one document an order, one row a record."""
    li = table(spark, d, "lineitem")
    def whole(c):
        return F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit("null"))

    number, supplier = whole("l_linenumber"), whole("l_suppkey")
    mixed = (F.when(F.col("l_linenumber") % 3 == 0, supplier)
             .when(F.col("l_linenumber") % 3 == 1, F.lit('"none"'))
             .otherwise(F.concat(F.lit('{"in": '), supplier, F.lit("}"))))
    flags = F.when(F.col("l_linenumber") > 2, F.array("l_returnflag", "l_linestatus")).otherwise(F.array("l_returnflag"))
    record = F.concat(F.lit('{"key": '), whole("l_orderkey"), F.lit(', "line": {"no": '), number, F.lit(', "deep": {"qty": '),
                      whole("l_quantity"), F.lit('}}, "flags": '), F.to_json(flags), F.lit(', "mixed": '), mixed,
                      F.lit(', "empty": []}'))
    docs = li.repartition("l_orderkey").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_join(F.collect_list(record), ",").alias("r"))
    docs = docs.select("id", F.concat(F.lit('{"value": ['), "r", F.lit("]}")).alias("doc"))
    return flatten_json(docs, "doc", keep=["id"], record_path="$.value")


def yearly_orders(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice",
                                         "o_orderpriority")
    first, last = o.select(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    frames = {}
    for y in range(first, last + 1):
        f = o.where((F.col("o_orderdate") >= F.lit(f"{y}-01-01").cast("timestamp_ntz")) &
                    (F.col("o_orderdate") < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz")))
        frames[y] = f if y % 2 else f.drop("o_orderpriority")
    return merge_years(frames, keep=["o_orderkey", "o_orderdate", "o_totalprice",
                                     "o_orderpriority"])


SQL_MERGED = """
SELECT o_orderkey, o_orderdate, o_totalprice,
       CASE WHEN year(o_orderdate) % 2 = 1 THEN o_orderpriority END AS o_orderpriority,
       cast(year(o_orderdate) AS integer) AS file_year
FROM orders"""


@query("merge_years", SQL_MERGED)
def q_merge_years(spark, d):
    return yearly_orders(spark, d)


def yearly_files(spark, d):
    """The orders as delimited files by year whose headers differ: even years lack the priority and have
    their columns in another order."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/yearly-orders-{uuid.uuid4().hex}"
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"),
                                         "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("file_year"))
    odd = F.col("file_year") % 2 == 1
    for name, rows in (("odd", o.where(odd)), ("even", o.where(~odd | odd.isNull()).select(
            "o_totalprice", "o_orderkey", "o_orderdate", "file_year"))):
        rows.write.partitionBy("file_year").option("header", True).csv(f"{folder}/{name}")
    return header_map(spark, folder)


YEAR_OF_PATH = r"file_year=(\d+)/"


@query("merge_drifting_files", SQL_MERGED)
def q_merge_drifting_files(spark, d):
    rows = read_drifting(spark, yearly_files(spark, d), ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"])
    return rows.select(F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
                       F.col("o_orderdate").try_cast("timestamp_ntz").alias("o_orderdate"),
                       F.col("o_totalprice").try_cast("double").alias("o_totalprice"), "o_orderpriority",
                       F.regexp_extract("file_path", YEAR_OF_PATH, 1).try_cast("int").alias("file_year"))


#: A file is there for each year of the orders; the priority is in those of the odd years.
@query("column_census", """
WITH years AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders WHERE o_orderdate IS NOT NULL)
SELECT unnest(['o_orderkey', 'o_orderdate', 'o_totalprice', 'o_orderpriority']) AS column_name,
       unnest([count(*), count(*), count(*), count(*) FILTER (y % 2 = 1)]) AS n_files
FROM years""")
def q_column_census(spark, d):
    return header_census(spark, yearly_files(spark, d), YEAR_OF_PATH)


@query("column_presence", f"""
WITH m AS ({SQL_MERGED})
SELECT 'o_orderkey' AS column_name,
       count(DISTINCT CASE WHEN o_orderkey IS NOT NULL THEN file_year END) AS n_files FROM m
UNION ALL SELECT 'o_orderdate',
       count(DISTINCT CASE WHEN o_orderdate IS NOT NULL THEN file_year END) FROM m
UNION ALL SELECT 'o_totalprice',
       count(DISTINCT CASE WHEN o_totalprice IS NOT NULL THEN file_year END) FROM m
UNION ALL SELECT 'o_orderpriority',
       count(DISTINCT CASE WHEN o_orderpriority IS NOT NULL THEN file_year END) FROM m""")
def q_column_presence(spark, d):
    return column_presence(yearly_orders(spark, d), "file_year")


# ---------------------------------------------------------------------------------------------
# 2.5 aggregations, 2.4 joins
# ---------------------------------------------------------------------------------------------


@query("daily_mean", SQL_DAILY)
def q_daily_mean(spark, d):
    return nation_daily(spark, d).drop("micro")


SQL_YEARLY = f"""
WITH d AS ({SQL_DAILY_MICRO})
SELECT n_nationkey, cast(year(dt) AS integer) AS year,
       sum(micro)::double / count(*) / 1e6 AS mean_price, count(*) AS n_days
FROM d WHERE year(dt) BETWEEN 1980 AND 2019 GROUP BY 1, 2"""


def nation_yearly(spark, d):
    y = rollup.yearly_mean(nation_daily(spark, d), "n_nationkey", value="micro",
                           out="mean_micro", start=1980, end=2019)
    return y.select("n_nationkey", "year", (F.col("mean_micro") / F.lit(1e6)).alias("mean_price"),
                    "n_days")


@query("yearly_mean", f"""
SELECT n_nationkey, year, {R('mean_price', 4)} AS mean_price, n_days FROM ({SQL_YEARLY})""")
def q_yearly_mean(spark, d):
    return nation_yearly(spark, d).withColumn("mean_price", rnd("mean_price", 4))


@query("dense_year_grid", f"""
WITH y AS ({SQL_YEARLY}),
g AS (SELECT k.n_nationkey, cast(t.yr AS integer) AS year
      FROM (SELECT DISTINCT n_nationkey FROM y) k, generate_series(1995, 2004) t(yr))
SELECT g.n_nationkey, g.year, {R('y.mean_price', 4)} AS mean_price
FROM g LEFT JOIN y USING (n_nationkey, year)""")
def q_dense_year_grid(spark, d):
    g = rollup.dense_period_grid(nation_yearly(spark, d), "n_nationkey", "year", "mean_price",
                                 1995, 2004)
    return g.withColumn("mean_price", rnd("mean_price", 4))


@query("sum_by_key_year", f"""
SELECT c_nationkey AS n_nationkey, cast(year(o_orderdate) AS integer) AS year,
       sum({SQL_CENTS})::double / 100 AS total
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'F' GROUP BY 1, 2""")
def q_sum_by_key_year(spark, d):
    j = priced_orders(spark, d, extra=["o_orderstatus"])
    s = rollup.sum_by_key_period(j, "n_nationkey", F.year("o_orderdate"), "cents",
                                 out="total_cents", where=F.col("o_orderstatus") == "F")
    return s.select("n_nationkey", "year", (F.col("total_cents") / 100).alias("total"))


@query("aqi_mortality_join", SQL_PAIRS + f"""
SELECT k AS n_nationkey, period, {R('x', 4)} AS x, y FROM p""")
def q_aqi_mortality_join(spark, d):
    return nation_pairs(spark, d).select("n_nationkey", "period", rnd("x", 4).alias("x"), "y")


@query("group_correlation", SQL_PAIRS + f"""
SELECT k AS n_nationkey, cast(count(*) FILTER (WHERE ok) AS integer) AS n,
       CASE WHEN count(*) FILTER (WHERE ok) >= 10 THEN {R(SQL_CORR, 6)} END AS beta
FROM v GROUP BY 1""")
def q_group_correlation(spark, d):
    r = stats.group_correlation(nation_pairs(spark, d), "n_nationkey", "x", "y", min_n=10)
    return r.withColumn("beta", rnd("beta", 6))


@query("series_collect", SQL_PAIRS + f"""
SELECT k AS n_nationkey, list(period ORDER BY period) FILTER (WHERE ok) AS periods,
       list({R('x', 4)} ORDER BY period) FILTER (WHERE ok) AS xs,
       list(y ORDER BY period) FILTER (WHERE ok) AS ys
FROM v GROUP BY 1""")
def q_series_collect(spark, d):
    p = nation_pairs(spark, d)
    s = rollup.series_collect(p, "n_nationkey", "period", ["x", "y"],
                              where=rollup.valid_pair("x", "y"))
    return s.select("n_nationkey", "periods",
                    F.transform("xs", lambda v: rnd(v, 4)).alias("xs"), "ys")


@query("group_standardize", SQL_PAIRS + f""",
s AS (SELECT k, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, stddev_pop(y) AS sy
      FROM p GROUP BY 1)
SELECT p.k AS n_nationkey, period, {R('(x - mx) / nullif(sx, 0)', 6)} AS x_z,
       {R('(y - my) / nullif(sy, 0)', 6)} AS y_z
FROM p JOIN s USING (k)""")
def q_group_standardize(spark, d):
    z = stats.group_standardize(nation_pairs(spark, d), "n_nationkey", ["x", "y"])
    return z.select("n_nationkey", "period", rnd("x_z", 6).alias("x_z"),
                    rnd("y_z", 6).alias("y_z"))


@query("merge_pollutants", f"""
WITH d AS (
  SELECT c_nationkey AS k, o_orderpriority AS pol, cast(o_orderdate AS date) AS dt,
         sum({SQL_CENTS})::double / count(*) / 100 AS m
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
x AS (SELECT k, pol, {sql_month('dt')} AS period,
      sum(cast(floor(m * 1e6 + 0.5) AS bigint))::double / count(*) / 1e6 AS x
      FROM d GROUP BY 1, 2, 3),
y AS (SELECT s_nationkey AS k, {sql_month('l_shipdate')} AS period, sum(l_quantity) AS y
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
p AS (SELECT x.k, x.pol, x.period, x.x, y.y FROM x LEFT JOIN y USING (k, period)
      WHERE x.k IN (SELECT k FROM y)),
v AS (SELECT *, (x IS NOT NULL AND NOT isnan(x) AND y IS NOT NULL AND y <> 0) AS ok FROM p),
b AS (SELECT k, pol, CASE WHEN count(*) FILTER (WHERE ok) >= 10 THEN {R(SQL_CORR, 6)}
      END AS beta FROM v GROUP BY 1, 2)
SELECT cast(k AS integer) AS county_id, pol AS pollutant, period, {R('x', 4)} AS x, y, beta
FROM v JOIN b USING (k, pol) WHERE ok""")
def q_merge_pollutants(spark, d):
    keys = ["n_nationkey", "o_orderpriority"]
    expo = nation_month_exposure(spark, d, keys=keys, extra=["o_orderpriority"])
    pairs = rollup.paired_series(expo, nation_month_outcome(spark, d), "n_nationkey", "period",
                                 "x", "y")
    reg = stats.group_correlation(pairs, keys, "x", "y", period="period", min_n=10,
                                  with_series=True)
    flat = rollup.explode_series(
        reg.select(F.col("n_nationkey").cast("int").alias("county_id"),
                   F.col("o_orderpriority").alias("pollutant"), rnd("beta", 6).alias("beta"),
                   "periods", "xs", "ys"),
        ["county_id", "pollutant", "beta"], ["periods", "xs", "ys"], ["period", "x", "y"])
    return flat.select("county_id", "pollutant", "period", rnd("x", 4).alias("x"), "y",
                       "beta")


# ---------------------------------------------------------------------------------------------
# 2.6 windows / series (daily mean price per nation as the AQI series)
# ---------------------------------------------------------------------------------------------

HOLDOUT = 300


def nation_windows(spark, d):
    return series.sliding_windows(nation_daily(spark, d), "n_nationkey", "dt", "mean_price",
                                  width=15, n_inputs=10)


SQL_WINDOWS = f"""
WITH d AS ({SQL_DAILY}),
w AS (SELECT n_nationkey, dt,
             cast(row_number() OVER (PARTITION BY n_nationkey ORDER BY dt) - 1 AS integer) AS start,
             count(*) OVER (PARTITION BY n_nationkey) AS n,
             list(mean_price) OVER (PARTITION BY n_nationkey ORDER BY dt
                                    ROWS BETWEEN CURRENT ROW AND 14 FOLLOWING) AS win
      FROM d),
wins AS (SELECT n_nationkey, start, dt AS first_dt, win[1:10] AS inputs, win[11:15] AS targets
         FROM w WHERE start <= n - 16),
hold AS (SELECT *, start > max(start) OVER (PARTITION BY n_nationkey) - {HOLDOUT} AS is_test
         FROM wins)"""


@query("series_lag_window", SQL_WINDOWS + """
SELECT * FROM wins""")
def q_series_lag_window(spark, d):
    return nation_windows(spark, d)


@query("tail_holdout", SQL_WINDOWS + """
SELECT n_nationkey, start, is_test FROM hold""")
def q_tail_holdout(spark, d):
    return series.tail_holdout(nation_windows(spark, d), "n_nationkey", n_test=HOLDOUT) \
        .select("n_nationkey", "start", "is_test")


def naive_predictions(spark, d):
    """Persistence stand-in forecast: step s repeats input 6+s (the last five readings)."""
    h = series.tail_holdout(nation_windows(spark, d), "n_nationkey", n_test=HOLDOUT)
    return h.where("is_test").withColumn("pred", F.slice("inputs", 6, 5))


@query("overlap_resolve", SQL_WINDOWS + """,
e AS (SELECT n_nationkey, start, start + i AS pos, inputs[6 + i] AS pred
      FROM hold, range(0, 5) r(i) WHERE is_test)
SELECT n_nationkey, cast(pos AS integer) AS pos, arg_max(pred, start) AS pred
FROM e GROUP BY 1, 2""")
def q_overlap_resolve(spark, d):
    return series.overlap_resolve(naive_predictions(spark, d), "n_nationkey")


@query("forecast_error", SQL_WINDOWS + f""",
e AS (SELECT n_nationkey,
             cast(floor(targets[1 + i] * 1e6 + 0.5) AS bigint)
             - cast(floor(inputs[6 + i] * 1e6 + 0.5) AS bigint) AS dm
      FROM hold, range(0, 5) r(i) WHERE is_test)
SELECT n_nationkey, count(dm) AS n,
       {R('sum(abs(dm))::double / count(dm) / 1e6', 4)} AS mae,
       {R('avg(pow(dm, 2)) / 1e12', 0)} AS mse
FROM e GROUP BY 1""")
def q_forecast_error(spark, d):
    def micro(c):
        return F.transform(c, lambda v: F.floor(v * F.lit(1e6) + F.lit(0.5)))
    p = naive_predictions(spark, d).select("n_nationkey", micro("targets").alias("targets"),
                                          micro("pred").alias("pred"))
    e = series.forecast_error(p, "n_nationkey", "targets", "pred")
    return e.select("n_nationkey", "n", rnd(F.col("mae") / F.lit(1e6), 4).alias("mae"),
                    rnd(F.col("mse") / F.lit(1e12), 0).alias("mse"))


@query("forecast_ar")
def q_forecast_ar(spark, d):
    from fipsight.operators.forecast import fit_ar, predict_ar
    h = series.tail_holdout(nation_windows(spark, d), "n_nationkey", n_test=HOLDOUT)
    coef = fit_ar(h.where(~F.col("is_test")), "n_nationkey", n_inputs=10, horizon=5)
    return predict_ar(h.where("is_test"), coef, "n_nationkey")


# ---------------------------------------------------------------------------------------------
# accidents: persons (line items) rolled up per accident (order)
# ---------------------------------------------------------------------------------------------


def persons(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        "l_orderkey",
        (F.col("l_quantity").cast("int") * 2 - 1).alias("age"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
         .otherwise(9).alias("sex"),
        (F.round(F.col("l_discount") * 100).cast("int") * 2).alias("ru"),
        F.year("l_shipdate").alias("yr"))


SQL_PERSON_ROLLUP = """
WITH p AS (SELECT l_orderkey, cast(l_quantity AS integer) * 2 - 1 AS age,
                  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 9 END AS sex,
                  cast(round(l_discount * 100) AS integer) * 2 AS ru,
                  year(l_shipdate) AS yr FROM lineitem),
q AS (SELECT *, age NOT IN (99, 999) AS known,
             (ru IN (17, 20) OR (yr < 2009 AND ru = 0)) AS unused FROM p)
SELECT l_orderkey,
  cast(count(*) FILTER (WHERE known AND age < 16) AS integer) AS age_lt16,
  cast(count(*) FILTER (WHERE known AND age >= 16 AND age < 30) AS integer) AS age_16_29,
  cast(count(*) FILTER (WHERE known AND age >= 30 AND age < 60) AS integer) AS age_30_59,
  cast(count(*) FILTER (WHERE known AND age >= 60) AS integer) AS age_60p,
  cast(count(*) FILTER (WHERE sex = 1) AS integer) AS sex1,
  cast(count(*) FILTER (WHERE sex = 2) AS integer) AS sex2,
  cast(count(*) FILTER (WHERE unused) AS integer) AS restraint_unused,
  cast(count(*) FILTER (WHERE NOT unused AND ru < 17) AS integer) AS restraint_used
FROM q GROUP BY 1"""


def person_counts(spark, d):
    return rollup.person_rollup(persons(spark, d), "l_orderkey", "age", "sex", "ru", year="yr")


@query("person_rollup", SQL_PERSON_ROLLUP)
def q_person_rollup(spark, d):
    return person_counts(spark, d)


@query("accident_person_join", f"""
WITH c AS ({SQL_PERSON_ROLLUP})
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, c.* EXCLUDE (l_orderkey)
FROM orders JOIN c ON o_orderkey = c.l_orderkey""")
def q_accident_person_join(spark, d):
    acc = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                           "o_orderpriority")
    cnt = person_counts(spark, d).withColumnRenamed("l_orderkey", "o_orderkey")
    return rollup.attach_person_counts(acc, cnt, "o_orderkey")


@query("fips_lookup", """
WITH lk AS (SELECT n_nationkey + 1000 AS fips, n_name || ' County' AS name,
                   cast(n_regionkey AS varchar) AS state FROM nation
            WHERE n_nationkey + 1000 > 1000),
pr AS (SELECT c_custkey, n_name AS county, cast(n_regionkey AS varchar) AS state
       FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, county, pr.state, fips
FROM pr LEFT JOIN lk ON pr.county || ' County' = lk.name AND pr.state = lk.state""")
def q_fips_lookup(spark, d):
    n = table(spark, d, "nation")
    lk = n.select((F.col("n_nationkey") + 1000).alias("fips"),
                  F.concat("n_name", F.lit(" County")).alias("name"),
                  F.col("n_regionkey").cast("string").alias("state"))
    probe = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select("c_custkey", F.col("n_name").alias("county"),
                F.col("n_regionkey").cast("string").alias("state"))
    return fips_lookup(probe, lk, "county", "state").select("c_custkey", "county", "state",
                                                            "fips")


# ---------------------------------------------------------------------------------------------
# 2.9 dates and clocks (events)
# ---------------------------------------------------------------------------------------------

SQL_HOURS = "round_even((epoch_us({e}) - epoch_us({s})) / 3.6e9 * 100.0, 0) / 100.0"


@query("date_parts", f"""
SELECT event_id, cast(year(ts) AS integer) AS year, cast(month(ts) AS integer) AS month,
       cast(dayofyear(ts) - 1 AS integer) AS day_of_year,
       {SQL_HOURS.format(s="date_trunc('day', ts)", e="ts")} AS hours
FROM events""")
def q_date_parts(spark, d):
    e = table(spark, d, "events")
    s = parse_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return e.select("event_id", F.year(s).alias("year"), F.month(s).alias("month"),
                    day_of_year0(s).alias("day_of_year"),
                    hours_between(F.date_trunc("DAY", s), F.col("ts").cast("timestamp"))
                    .alias("hours"))


def _arrival(e):
    mins = F.floor(F.col("value") * 3).cast("int")
    return e.withColumn("arr", F.col("ts") + F.make_dt_interval(mins=mins))


SQL_ARRIVAL = """SELECT *, ts + to_minutes(cast(floor(value * 3) AS bigint)) AS arr FROM events"""


@query("response_minutes", f"""
WITH t AS ({SQL_ARRIVAL}),
u AS (SELECT event_id, hour(ts) AS ch, minute(ts) AS cm,
             CASE WHEN event_type = 'error' THEN 99 ELSE hour(arr) END AS ah,
             minute(arr) AS am FROM t)
SELECT event_id, cast(ch AS integer) AS crash_hour, cast(cm AS integer) AS crash_min,
       cast(ah AS integer) AS arr_hour, cast(am AS integer) AS arr_min,
       CASE WHEN ah BETWEEN 0 AND 23 AND am BETWEEN 0 AND 59 AND ch BETWEEN 0 AND 23
                 AND cm BETWEEN 0 AND 59
            THEN cast(abs((ah * 60 + am) - (ch * 60 + cm)
                          + CASE WHEN ah < ch THEN 1440 ELSE 0 END) AS integer) END AS minutes
FROM u""")
def q_response_minutes(spark, d):
    e = _arrival(table(spark, d, "events"))
    c = e.select("event_id", F.hour("ts").alias("crash_hour"), F.minute("ts").alias("crash_min"),
                 F.when(F.col("event_type") == "error", F.lit(99)).otherwise(F.hour("arr"))
                  .alias("arr_hour"), F.minute("arr").alias("arr_min"))
    return c.withColumn("minutes", response_minutes("arr_hour", "arr_min", "crash_hour",
                                                    "crash_min"))


@query("feature_prep", f"""
WITH t AS (SELECT event_id, user_id, ts, arr,
                  CASE WHEN event_type = 'view' THEN 'R' ELSE 'L' END AS side,
                  json_extract_string(props, '$.k') AS k_text
           FROM ({SQL_ARRIVAL}))
SELECT event_id, user_id, cast(year(ts) AS integer) AS year, cast(month(ts) AS integer) AS month,
       cast(dayofyear(ts) - 1 AS integer) AS day_of_year,
       {SQL_HOURS.format(s="ts", e="arr")} AS duration_h,
       CASE WHEN side = 'R' THEN 1 ELSE 0 END AS side_flag,
       try_cast(k_text AS bigint) AS k_text,
       CASE WHEN try_cast(k_text AS bigint) > 50 THEN 1 ELSE 0 END AS flag
FROM t""")
def q_feature_prep(spark, d):
    e = _arrival(table(spark, d, "events"))
    k = F.get_json_object("props", "$.k")
    e = e.select("event_id", "user_id", "ts", "arr", "value", "props",
                 F.when(F.col("event_type") == "view", "R").otherwise("L").alias("side"),
                 k.alias("k_text"),
                 F.when(k.try_cast("bigint") > 50, "True").otherwise("False").alias("flag"))
    return feature_prep(e, "ts", "arr", "side", flags=["flag"], numeric={"k_text": "bigint"},
                        keep=["event_id", "user_id", "k_text"], drop=["props", "value"])


# ---------------------------------------------------------------------------------------------
# 2.5 profiles: histograms, screen, selection (suppliers as counties)
# ---------------------------------------------------------------------------------------------

PROFILE_FEATURES = ["l_linenumber", "flag_code", "discount_pct"]


SQL_PROFILE_WIDE = """
SELECT {ids}, cast(l_linenumber AS double) AS l_linenumber,
       cast(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS double) AS flag_code,
       cast(round(l_discount * 100) AS double) AS discount_pct FROM lineitem"""
SQL_HIST = f"""
WITH li AS ({SQL_PROFILE_WIDE.format(ids='l_suppkey')}),
lg AS (UNPIVOT li ON l_linenumber, flag_code, discount_pct INTO NAME feature VALUE value),
h AS (SELECT l_suppkey, feature, value, count(*) AS cnt FROM lg GROUP BY ALL),
hist AS (SELECT h.*, cast(sum(cnt) OVER (PARTITION BY l_suppkey, feature) AS bigint) AS n_rows
         FROM h),
screen AS (SELECT l_suppkey, feature,
                  cast(count(*) FILTER (WHERE cnt * 100 >= n_rows * 10) AS integer) AS n_frequent
           FROM hist GROUP BY ALL HAVING count(*) FILTER (WHERE cnt * 100 >= n_rows * 10) >= 2)"""


def profile_wide(spark, d, ids=("l_suppkey",)):
    li = table(spark, d, "lineitem")
    return li.select(*ids, "l_linenumber",
                     F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
                      .otherwise(3).alias("flag_code"),
                     F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"))


def supplier_histogram(spark, d):
    return feature_histogram(profile_wide(spark, d), "l_suppkey", PROFILE_FEATURES)


@query("value_histogram", SQL_HIST + """
SELECT * FROM hist""")
def q_value_histogram(spark, d):
    return supplier_histogram(spark, d)


@query("frequency_screen", SQL_HIST + """
SELECT * FROM screen""")
def q_frequency_screen(spark, d):
    return frequency_screen(supplier_histogram(spark, d), "l_suppkey")


@query("feature_screen", SQL_HIST + """
SELECT * FROM screen""")
def q_feature_screen(spark, d):
    """The same screen from mergeable summaries of the wide rows."""
    return feature_screen(profile_wide(spark, d), "l_suppkey", PROFILE_FEATURES)


@query("selected_features_semi", SQL_HIST + f""",
wide AS ({SQL_PROFILE_WIDE.format(ids='l_suppkey, l_orderkey, l_linenumber AS line_no')}),
lg2 AS (UNPIVOT wide ON l_linenumber, flag_code, discount_pct INTO NAME feature VALUE value)
SELECT * FROM lg2 SEMI JOIN screen USING (l_suppkey, feature)""")
def q_selected_features_semi(spark, d):
    li = table(spark, d, "lineitem").withColumn("line_no", F.col("l_linenumber"))
    w = li.select("l_suppkey", "l_orderkey", "line_no", "l_linenumber",
                  F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
                   .otherwise(3).alias("flag_code"),
                  F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"))
    long = unpivot_features(w, ["l_suppkey", "l_orderkey", "line_no"], PROFILE_FEATURES)
    screen = frequency_screen(supplier_histogram(spark, d), "l_suppkey")
    return keep_selected(long, screen, "l_suppkey")


# ---------------------------------------------------------------------------------------------
# 2.11 regression from Gram tables (line items by return flag x line status)
# ---------------------------------------------------------------------------------------------

OLS_KEYS = ["l_returnflag", "l_linestatus"]
OLS_FEATURES = ["l_quantity", "l_discount", "l_tax"]
OLS_TARGET = "l_extendedprice"


def _sql_gram() -> str:
    parts = []
    pairs = [(a, b) for i, a in enumerate(OLS_FEATURES) for b in OLS_FEATURES[i:] + [OLS_TARGET]]
    pairs.append((OLS_TARGET, OLS_TARGET))
    for a, b in pairs:
        if a == b:
            g = f"CASE WHEN stddev_pop({a}) > 0 THEN count(*)::double END"
        else:
            g = f"count(*) * covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"
        parts.append(f"SELECT l_returnflag, l_linestatus, '{a}' AS f1, '{b}' AS f2, "
                     f"{R(g, 4)} AS gram, count(*) AS n FROM lineitem GROUP BY 1, 2")
    return "\nUNION ALL ".join(parts)


def line_gram(spark, d):
    li = table(spark, d, "lineitem")
    return stats.gram_table(li, OLS_KEYS, OLS_FEATURES, OLS_TARGET)


@query("group_ols_gram", _sql_gram())
def q_group_ols_gram(spark, d):
    return line_gram(spark, d).withColumn("gram", rnd("gram", 4))


@query("group_ols")
def q_group_ols(spark, d):
    moments = pattern_moments(table(spark, d, "lineitem"), OLS_KEYS, OLS_FEATURES, OLS_TARGET)
    return stats.ols(moments, OLS_KEYS, OLS_FEATURES, OLS_TARGET)


#: Complete cases of two columns that drift: one is there in a part of the year, one for some lines.
#: Standardised betas, one standard error sqrt(rss / dof / 2n), and the one-sided tail of Student's t by its
#: finite sums for whole degrees of freedom (odd and even).
SQL_OLS_MISSING = f"""
WITH drift AS (SELECT l_returnflag, l_linestatus, CASE WHEN month(l_shipdate) <= 8 THEN l_discount END AS a,
                      CASE WHEN l_linenumber <> 3 THEN l_tax END AS b,
                      CASE WHEN l_suppkey % 7 <> 0 THEN l_extendedprice END AS y FROM lineitem),
m AS (SELECT l_returnflag, l_linestatus, count(*) AS n, corr(a, y) AS ay, corr(b, y) AS by_, corr(a, b) AS ab
      FROM drift WHERE a IS NOT NULL AND b IS NOT NULL AND y IS NOT NULL GROUP BY ALL),
f AS (SELECT l_returnflag, l_linestatus, n, n - 3 AS dof,
             unnest([(ay - ab * by_) / (1 - ab * ab), (by_ - ab * ay) / (1 - ab * ab)]) AS beta,
             unnest(['early', 'no_third']) AS feature,
             1 - (ay * ay + by_ * by_ - 2 * ab * ay * by_) / (1 - ab * ab) AS rest FROM m),
t AS (SELECT *, beta / sqrt(rest / dof / 2) AS t FROM f),
angle AS (SELECT *, atan(abs(t) / sqrt(dof)) AS a FROM t),
tail AS (SELECT *, CASE WHEN dof % 2 = 0
    THEN sin(a) * (1 + list_sum(list_append(list_transform(range(1, dof // 2),
           lambda j: exp(lgamma(j + 0.5) - lgamma(j + 1) + 2 * j * ln(cos(a))) / sqrt(pi())), 0)))
    ELSE 2 / pi() * (a + sin(a) * (cos(a) + list_sum(list_append(list_transform(range(1, (dof - 1) // 2),
           lambda j: exp(lgamma(j + 1) - lgamma(j + 1.5) + (2 * j + 1) * ln(cos(a))) * sqrt(pi()) / 2), 0)))) END AS inside
    FROM angle)
SELECT l_returnflag, l_linestatus, feature, {R('beta', 6)} AS beta, {R('t', 4)} AS t, dof, 'ok' AS status,
       {R('(1 - inside) / 2', 6)} AS p_value FROM tail"""


@query("group_ols_missing", SQL_OLS_MISSING)
def q_group_ols_missing(spark, d):
    """Regression on columns that drift out of some rows, with its p-values."""
    li = table(spark, d, "lineitem").select(
        *OLS_KEYS, F.when(F.month("l_shipdate") <= 8, F.col("l_discount")).alias("early"),
        F.when(F.col("l_linenumber") != 3, F.col("l_tax")).alias("no_third"),
        F.when(F.col("l_suppkey") % 7 != 0, F.col(OLS_TARGET)).alias("price"))
    feats = ["early", "no_third"]
    fit = stats.ols(pattern_moments(li, OLS_KEYS, feats, "price"), OLS_KEYS, feats, "price")
    return fit.select(*OLS_KEYS, "feature", rnd("beta", 6).alias("beta"), rnd("t", 4).alias("t"), "dof", "status",
                      rnd("p_value", 6).alias("p_value"))


# ---------------------------------------------------------------------------------------------
# 2.11 nearest neighbours, feature selection, principal components (embeddings / line items)
# ---------------------------------------------------------------------------------------------

KNN_K = 5
KNN_FOLDS = 5
EMB_DIMS = 64


def _sql_knn(points: str, distance: str, k: int = KNN_K) -> str:
    """``points``: grp, id, label, v; ``distance``: of q.v and t.v."""
    f = KNN_FOLDS

    def upto(m, g):
        return f"floor(({m} - {g} + {f}) / {f})"

    cum, terms = [], []
    for g in range(f - 1):
        cum.append(f"({upto('s_k + n_k - 1', g)} - {upto('s_k - 1', g)})")
        terms.append(f"CASE WHEN {' + '.join(cum)} <= rk THEN 1 ELSE 0 END")
    fold = " + ".join(terms)
    return f"""
WITH p AS ({points}),
c AS (SELECT grp, label, count(*) AS n_k FROM p GROUP BY 1, 2),
s AS (SELECT grp, label, n_k, coalesce(sum(n_k) OVER (PARTITION BY grp ORDER BY label
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s_k FROM c),
r AS (SELECT p.*, row_number() OVER (PARTITION BY p.grp, p.label ORDER BY p.id) - 1 AS rk,
             s.n_k, s.s_k FROM p JOIN s USING (grp, label)),
f AS (SELECT grp, id, label, v, cast({fold} AS integer) AS fold FROM r),
pairs AS (SELECT q.grp, q.id AS qid, q.label AS ql, q.fold AS qf, t.id AS tid, t.label AS tl,
                 {distance} AS d
          FROM f q JOIN f t ON q.grp = t.grp AND q.fold <> t.fold),
nn AS (SELECT * FROM pairs
       QUALIFY row_number() OVER (PARTITION BY grp, qid ORDER BY d, tid) <= {k}),
votes AS (SELECT grp, qid, ql, qf, tl, count(*) AS c FROM nn GROUP BY ALL),
pred AS (SELECT * FROM votes
         QUALIFY row_number() OVER (PARTITION BY grp, qid ORDER BY c DESC, tl) = 1)
SELECT grp, cast(qf AS integer) AS fold, count(*) AS n_test,
       count(*) FILTER (WHERE tl = ql) AS n_correct,
       count(*) FILTER (WHERE tl = ql) / count(*) AS accuracy
FROM pred GROUP BY 1, 2"""


SQL_EMBEDDED = ("SELECT vec_id // 500 AS grp, vec_id AS id, cast(label AS bigint) AS label, "
                "cast(embedding AS double[]) AS v FROM embeddings")


@query("knn_cv_accuracy", _sql_knn(SQL_EMBEDDED, f"""list_sum(list_transform(range(1, {EMB_DIMS + 1}),
                          lambda i: (q.v[i] - t.v[i]) * (q.v[i] - t.v[i])))"""))
def q_knn_cv_accuracy(spark, d):
    from fipsight.operators.select import knn_cv_accuracy
    e = table(spark, d, "embeddings").withColumn("grp", F.floor(F.col("vec_id") / 500))  # stand-in counties
    return knn_cv_accuracy(e, "grp", "vec_id", "label", "embedding", k=KNN_K, folds=KNN_FOLDS)


#: Whole numbers, so that distances and their ties are exact.
SQL_SOURCES = ("SELECT source AS grp, doc_id AS id, lang AS label, [n_chars, strlen(text) - n_chars, "
               "length(text) - length(replace(text, ' ', ''))] AS v FROM documents")


@query("knn_cv_skewed", _sql_knn(SQL_SOURCES, """cast((q.v[1] - t.v[1]) * (q.v[1] - t.v[1])
    + (q.v[2] - t.v[2]) * (q.v[2] - t.v[2]) + (q.v[3] - t.v[3]) * (q.v[3] - t.v[3]) AS double)"""))
def q_knn_cv_skewed(spark, d):
    """Groups of very uneven size (one source holds a third of the rows), the largest beyond one block:
    the language of a text from three of its lengths."""
    from fipsight.operators.select import knn_cv_accuracy
    text = table(spark, d, "documents").select(
        F.col("source").alias("grp"), "doc_id", "lang", "n_chars",
        (F.octet_length("text") - F.col("n_chars")).alias("wide"),
        (F.char_length("text") - F.char_length(F.replace("text", F.lit(" "), F.lit("")))).alias("blanks"))
    return knn_cv_accuracy(text, "grp", "doc_id", "lang", ["n_chars", "wide", "blanks"], k=KNN_K, folds=KNN_FOLDS,
                           block_rows=128)


SELECT_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "ship_month",
                   "ship_dow", "flag_code"]


@query("select_features")
def q_select_features(spark, d):
    from fipsight.operators.select import select_features
    li = table(spark, d, "lineitem")
    w = li.select("l_suppkey", "l_orderkey", "l_extendedprice",
                  *[c for c in SELECT_FEATURES if c.startswith("l_")],
                  F.month("l_shipdate").alias("ship_month"),
                  F.dayofweek("l_shipdate").alias("ship_dow"),
                  F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
                   .otherwise(3).alias("flag_code"))
    screen = feature_screen(w, "l_suppkey", SELECT_FEATURES)
    moments = pattern_moments(w, "l_suppkey", SELECT_FEATURES, "l_extendedprice")
    return select_features(moments, "l_suppkey", SELECT_FEATURES, "l_extendedprice", k=3,
                           allowed=screen)


PCA_K = 10


def _pca(spark, d):
    from fipsight.operators.decompose import pca_fit
    return pca_fit(table(spark, d, "embeddings"), "embedding", PCA_K, keep=["vec_id", "label"])


@query("pca_scores")
def q_pca_scores(spark, d):
    from fipsight.operators.decompose import pca_scores
    return pca_scores(_pca(spark, d), keep=["vec_id", "label"])


@query("pca_cumvar")
def q_pca_cumvar(spark, d):
    from fipsight.operators.decompose import explained_variance
    return explained_variance(spark, _pca(spark, d))


@query("pca_loadings")
def q_pca_loadings(spark, d):
    from fipsight.operators.decompose import loadings
    return loadings(spark, _pca(spark, d))


@query("pca_significance")
def q_pca_significance(spark, d):
    from fipsight.operators.decompose import loadings, significance
    return significance(loadings(spark, _pca(spark, d)))


@query("select_features_knn")
def q_select_features_knn(spark, d):
    """Same selection with the original scoring rule: 2-NN accuracy under stratified 5-fold CV,
    the line item's return flag as the class to predict (suppliers as counties)."""
    from fipsight.operators.select import select_features_knn
    li = table(spark, d, "lineitem")
    w = li.select("l_suppkey", "l_orderkey", "l_linenumber",
                  (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
                  F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
                   .otherwise(3).alias("flag_code"),
                  "l_quantity", "l_discount", "l_tax",
                  F.month("l_shipdate").alias("ship_month"),
                  F.dayofweek("l_shipdate").alias("ship_dow"))
    feats = ["l_linenumber", "l_quantity", "l_discount", "l_tax", "ship_month", "ship_dow"]
    screen = feature_screen(w, "l_suppkey", feats)
    return select_features_knn(w, "l_suppkey", "row_id", "flag_code", feats, k=3,
                               n_neighbors=2, allowed=screen)


#: Each of the two features is a group of its own; the better one is chosen, the first if they are equal.
SQL_ONE_OF_TWO = _sql_knn(
    "SELECT c_nationkey * 2 + f AS grp, c_custkey AS id, c_mktsegment AS label, "
    "[CASE f WHEN 0 THEN c_acctbal ELSE cast(c_custkey AS double) END] AS v FROM customer, range(2) u(f)",
    "(q.v[1] - t.v[1]) * (q.v[1] - t.v[1])", k=2)


@query("select_one_knn", f"""
WITH folds AS ({SQL_ONE_OF_TWO}),
scores AS (SELECT grp // 2 AS c_nationkey, grp % 2 AS f, list_sum(list(accuracy ORDER BY fold)) / count(*) AS score
           FROM folds GROUP BY grp),
best AS (SELECT c_nationkey, arg_max(f, score - f * 1e-13) AS f, max(score) AS score FROM scores GROUP BY 1),
sizes AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)
SELECT c_nationkey, n, CASE WHEN n < 10 THEN 'too_few_rows' ELSE 'ok' END AS status,
       CASE WHEN n < 10 THEN '' WHEN f = 0 THEN 'c_acctbal' ELSE 'c_custkey' END AS chosen,
       CASE WHEN n >= 10 THEN {R('score', 6)} END AS score
FROM sizes LEFT JOIN best USING (c_nationkey)""")
def q_select_one_knn(spark, d):
    """The better of two features by the k-NN rule: customers by nation, their market segment as the class."""
    from fipsight.operators.select import select_features_knn
    c = table(spark, d, "customer")
    sel = select_features_knn(c, "c_nationkey", "c_custkey", "c_mktsegment", ["c_acctbal", "c_custkey"], k=1, n_neighbors=2)
    return sel.select("c_nationkey", "n", "status", F.array_join("features", ",").alias("chosen"), rnd("score", 6).alias("score"))


# ---------------------------------------------------------------------------------------------
# small bindings of the solver operators that SQL can express in closed form
# ---------------------------------------------------------------------------------------------

#: One feature: beta = r, rss = n (1 - r^2), one standard error sqrt(rss / dof / n).
SQL_OLS_ONE = f"""
WITH m AS (SELECT l_returnflag, l_linestatus, count(*) AS n, corr(l_quantity, l_extendedprice) AS r
           FROM lineitem GROUP BY ALL),
f AS (SELECT l_returnflag, l_linestatus, 'l_quantity' AS feature, {R('r', 6)} AS beta,
             {R('r / sqrt((1 - r * r) / (n - 2))', 3)} AS t, n - 2 AS dof, 'ok' AS status FROM m)"""


def _ols_one(spark, d, allowed=None):
    li = table(spark, d, "lineitem")
    moments = pattern_moments(li, OLS_KEYS, ["l_quantity"], OLS_TARGET)
    fit = stats.ols(moments, OLS_KEYS, ["l_quantity"], OLS_TARGET, allowed=allowed)
    return fit.select(*OLS_KEYS, "feature", rnd("beta", 6).alias("beta"), rnd("t", 3).alias("t"), "dof",
                      "status")


@query("group_ols_one", SQL_OLS_ONE + """
SELECT * FROM f""")
def q_group_ols_one(spark, d):
    return _ols_one(spark, d)


@query("group_ols_selected", SQL_OLS_ONE + """
SELECT * FROM f WHERE l_returnflag <> 'N'
UNION ALL SELECT l_returnflag, l_linestatus, NULL, NULL, NULL, NULL, 'not_selected'
FROM m WHERE l_returnflag = 'N'""")
def q_group_ols_selected(spark, d):
    """A selection that does not name the groups of one return flag: they stay, unfitted."""
    named = table(spark, d, "lineitem").where("l_returnflag <> 'N'").select(
        *OLS_KEYS, F.lit("l_quantity").alias("feature")).distinct()
    return _ols_one(spark, d, named)


@query("select_two_features", f"""
WITH m AS (SELECT l_suppkey, count(*) AS n, corr(l_quantity, l_extendedprice) AS rq,
                  corr(l_discount, l_extendedprice) AS rd, corr(l_tax, l_extendedprice) AS rt,
                  corr(l_quantity, l_discount) AS qd, corr(l_quantity, l_tax) AS qt, corr(l_discount, l_tax) AS dt
           FROM lineitem GROUP BY l_suppkey),
s AS (SELECT *, CASE WHEN rq * rq >= greatest(rd * rd, rt * rt) THEN 'q'
                     WHEN rd * rd >= rt * rt THEN 'd' ELSE 't' END AS best,
             (rq * rq + rd * rd - 2 * rq * rd * qd) / (1 - qd * qd) AS r_qd,
             (rq * rq + rt * rt - 2 * rq * rt * qt) / (1 - qt * qt) AS r_qt,
             (rd * rd + rt * rt - 2 * rd * rt * dt) / (1 - dt * dt) AS r_dt FROM m),
p AS (SELECT *, CASE best WHEN 'q' THEN CASE WHEN r_qd >= r_qt THEN 'qd' ELSE 'qt' END
                          WHEN 'd' THEN CASE WHEN r_qd >= r_dt THEN 'qd' ELSE 'dt' END
                          ELSE CASE WHEN r_qt >= r_dt THEN 'qt' ELSE 'dt' END END AS pair FROM s)
SELECT l_suppkey, n, CASE WHEN n < 10 THEN 'too_few_rows' ELSE 'ok' END AS status,
       CASE WHEN n < 10 THEN '' WHEN pair = 'qd' THEN 'l_quantity,l_discount'
            WHEN pair = 'qt' THEN 'l_quantity,l_tax' ELSE 'l_discount,l_tax' END AS chosen,
       CASE WHEN n >= 10 THEN {R("CASE pair WHEN 'qd' THEN r_qd WHEN 'qt' THEN r_qt ELSE r_dt END", 6)} END AS r2
FROM p""")
def q_select_two_features(spark, d):
    from fipsight.operators.select import select_features
    li, feats = table(spark, d, "lineitem"), OLS_FEATURES
    sel = select_features(pattern_moments(li, "l_suppkey", feats, OLS_TARGET), "l_suppkey", feats, OLS_TARGET, k=2)
    return sel.select("l_suppkey", "n", "status", F.array_join("features", ",").alias("chosen"), rnd("r2", 6).alias("r2"))


def _scaled_price():
    return (F.col("mean_price") - F.lit(150000.0)) / F.lit(100000.0)


@query("forecast_ar_one", f"""
WITH d AS (SELECT n_nationkey, dt, (mean_price - 150000.0::double) / 100000.0::double AS v FROM ({SQL_DAILY})),
w AS (SELECT n_nationkey, v AS x, lead(v) OVER (PARTITION BY n_nationkey ORDER BY dt) AS y,
             row_number() OVER (PARTITION BY n_nationkey ORDER BY dt) - 1 AS start,
             count(*) OVER (PARTITION BY n_nationkey) AS n FROM d)
SELECT n_nationkey, count(*) AS n_windows, {R('regr_intercept(y, x)', 6)} AS intercept,
       {R('regr_slope(y, x)', 6)} AS slope
FROM w WHERE start <= n - 3 GROUP BY n_nationkey""")
def q_forecast_ar_one(spark, d):
    """One lag, one step: the fit is simple regression of each reading on the one before."""
    from fipsight.operators.forecast import fit_ar
    s = nation_daily(spark, d).select("n_nationkey", "dt", _scaled_price().alias("v"))
    w = series.sliding_windows(s, "n_nationkey", "dt", "v", width=2, n_inputs=1)
    c = fit_ar(w, "n_nationkey", n_inputs=1, horizon=1)
    return c.select("n_nationkey", "n_windows", rnd(F.col("coef")[0][0], 6).alias("intercept"),
                    rnd(F.col("coef")[0][1], 6).alias("slope"))


#: Two standardised columns: eigenvalues 1 + |r| and 1 - |r|, components (1, ±1) / sqrt(2).
SQL_PCA_TWO = """
WITH m AS (SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem)"""


def _pca_two(spark, d):
    from fipsight.operators.decompose import pca_fit
    return pca_fit(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"], 2)


@query("pca_two_variance", SQL_PCA_TWO + f"""
SELECT 0 AS component, {R('(1 + abs(r)) / 2', 6)} AS ratio, {R('(1 + abs(r)) / 2', 6)} AS cumulative FROM m
UNION ALL SELECT 1, {R('(1 - abs(r)) / 2', 6)}, 1.0::double FROM m""")
def q_pca_two_variance(spark, d):
    from fipsight.operators.decompose import explained_variance
    v = explained_variance(spark, _pca_two(spark, d))
    return v.select("component", rnd("ratio", 6).alias("ratio"), rnd("cumulative", 6).alias("cumulative"))


@query("composite_id_dirty", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0
       THEN cast(o_orderkey AS varchar) || cast(year(o_orderdate) AS varchar) END AS id
FROM orders""")
def q_composite_id_dirty(spark, d):
    """Case numbers written as floats, years as doubles, and text that is no number."""
    o = table(spark, d, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("double").alias("year"),
        F.when(F.col("o_orderkey") % 7 == 0, "unknown")
        .otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0"))).alias("case"))
    return o.select("o_orderkey", composite_id("case", "year").alias("id"))


@query("pca_two_scores", f"""
SELECT l_orderkey, l_linenumber, l_returnflag,
       {R("""((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER ()
           + (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER ()) / sqrt(2)""", 4)} AS score
FROM lineitem""")
def q_pca_two_scores(spark, d):
    """First component scores beside the target; the two columns correlate positively."""
    from fipsight.operators.decompose import pca_fit, pca_scores
    kept = ["l_orderkey", "l_linenumber", "l_returnflag"]
    fit = pca_fit(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"], 2, keep=kept)
    return pca_scores(fit, keep=kept).select(*kept, rnd(F.col("scores")[0], 4).alias("score"))


#: Loadings sqrt(eigenvalue / 2 * n / (n - 1)); the second component's signs are free, so sizes are compared.
@query("pca_two_loadings", f"""
WITH m AS (SELECT corr(l_quantity, l_extendedprice) AS r, count(*) AS n FROM lineitem)
SELECT unnest(['l_quantity', 'l_extendedprice', 'l_quantity', 'l_extendedprice']) AS feature, unnest([0, 0, 1, 1]) AS component,
       unnest([{R('sqrt((1 + abs(r)) / 2 * n / (n - 1))', 6)}, {R('sqrt((1 + abs(r)) / 2 * n / (n - 1))', 6)},
               {R('sqrt((1 - abs(r)) / 2 * n / (n - 1))', 6)}, {R('sqrt((1 - abs(r)) / 2 * n / (n - 1))', 6)}]) AS size
FROM m""")
def q_pca_two_loadings(spark, d):
    from fipsight.operators.decompose import loadings
    return loadings(spark, _pca_two(spark, d)).select("feature", "component", rnd(F.abs("loading"), 6).alias("size"))


@query("pca_two_significance", f"""
SELECT unnest(['l_quantity', 'l_extendedprice']) AS feature, {R('sqrt(count(*) / (count(*) - 1))', 6)} AS significance FROM lineitem""")
def q_pca_two_significance(spark, d):
    from fipsight.operators.decompose import loadings, significance
    found = significance(loadings(spark, _pca_two(spark, d)))
    return found.select("feature", rnd("significance", 6).alias("significance"))


@query("selected_histograms", SQL_HIST + """
SELECT hist.* FROM hist SEMI JOIN screen USING (l_suppkey, feature)""")
def q_selected_histograms(spark, d):
    """Histograms of the features that pass each supplier's screen, from the wide rows."""
    wide = profile_wide(spark, d)
    chosen = feature_screen(wide, "l_suppkey", PROFILE_FEATURES).groupBy("l_suppkey").agg(F.collect_list("feature").alias("features"))
    return chosen_histograms(wide, chosen, "l_suppkey", PROFILE_FEATURES)


@query("select_excluding", ORACLE["select_two_features"])
def q_select_excluding(spark, d):
    """A column that gives the target away is left out of the selection."""
    from fipsight.operators.select import select_features
    li, feats = table(spark, d, "lineitem").withColumn("leak", F.col(OLS_TARGET) * 2 + 1), [*OLS_FEATURES, "leak"]
    sel = select_features(pattern_moments(li, "l_suppkey", feats, OLS_TARGET), "l_suppkey", feats, OLS_TARGET, k=2, exclude=["leak"])
    return sel.select("l_suppkey", "n", "status", F.array_join("features", ",").alias("chosen"), rnd("r2", 6).alias("r2"))


# ---------------------------------------------------------------------------------------------
# 2.1 text files: tables written as delimited text to the shared folder and read back
# ---------------------------------------------------------------------------------------------


def _text_folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("csv_scan", """
SELECT c_custkey, c_name || ' é' AS c_name, c_acctbal, c_mktsegment, NULL::varchar AS phone, CAST(c_nationkey AS varchar) AS nation
FROM customer""")
def q_csv_scan(spark, d):
    """Many files with a header each, not in UTF-8, columns by name and type, one of them absent, and a token
    of the file's path as a column."""
    folder = _text_folder(spark, "customers")
    c = table(spark, d, "customer").withColumn("c_name", F.concat("c_name", F.lit(" é")))
    c.repartition("c_nationkey").write.partitionBy("c_nationkey").option("header", True).option("encoding", "ISO-8859-1").csv(folder)
    rows = read_csv(spark, f"{folder}/*/", "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string, phone string",
                    encoding="ISO-8859-1")
    return with_path_token(rows, "nation", r"c_nationkey=(\d+)/")


@query("series_text", f"""
SELECT CAST(n_nationkey AS varchar) AS fips, dt, mean_price AS aqi FROM ({SQL_DAILY})""")
def q_series_text(spark, d):
    """The hand-over of daily means as lines without a header."""
    folder = _text_folder(spark, "series")
    nation_daily(spark, d).select("n_nationkey", "dt", "mean_price").write.csv(folder)
    return read_series_text(spark, folder)


@query("single_report", f"""
SELECT n_nationkey, year, {R('mean_price', 4)} AS mean_price, n_days FROM ({SQL_YEARLY})""")
def q_single_report(spark, d):
    """The final report as one file with a header."""
    folder = _text_folder(spark, "report")
    write_single_csv(nation_yearly(spark, d).withColumn("mean_price", rnd("mean_price", 4)), folder)
    return read_csv(spark, folder, "n_nationkey int, year int, mean_price double, n_days bigint")
