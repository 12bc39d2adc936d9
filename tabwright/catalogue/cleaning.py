"""Profiles, cleaning, capping, scaling and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.catalogue.tables import CASES, HOLED_ORDERS, cases, gap, holed_orders, rounded, table
from tabwright.functions.stage import scratch_path
from tabwright.operators.clean import drop_duplicate_rows, duplicate_report, fit_imputer, parse_dates
from tabwright.operators.encode import fit_label, fit_onehot
from tabwright.operators.outliers import fit_capper
from tabwright.operators.profile import clean_column_names, features_profile, missing_report, table_profile
from tabwright.operators.scale import fit_scaler
from tabwright.plans.preprocess import fit_preprocessing
from tabwright.sources.tables import read_csv, write_csv
from tabwright.spec import PipelineSpec


def validate_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(table_profile(holed_orders(spark, folder)), "missing_ratio")


def features_check(spark: SparkSession, folder: str) -> DataFrame:
    return features_profile(holed_orders(spark, folder), ["o_custkey", "o_totalprice"], "o_orderpriority")


def missing_values(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(missing_report(holed_orders(spark, folder)), "missing_ratio")


def clean_names(spark: SparkSession, folder: str) -> DataFrame:
    messy = table(spark, folder, "customer").toDF("  C CustKey ", "C-Name (Full)", "Nation*Key", "Acct   Bal!", "시장 구분#")
    return clean_column_names(messy)


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 == 0, F.lit("N/A")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit("NaN")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.concat(F.lit('say "'), "c_mktsegment", F.lit('", twice')).alias("quoted"),
        (F.col("c_nationkey") % 2 == 0).alias("even"),
    )
    path = scratch_path(spark) + ".csv"
    write_csv(customer, path)
    return read_csv(spark, path)


def csv_separator(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark) + ".csv"
    write_csv(table(spark, folder, "supplier"), path, sep=";")
    return read_csv(spark, path, sep=";")


def dates_parsed(spark: SparkSession, folder: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    text = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k == 1, F.date_format(d, "yyyy-M-d"))
        .when(k == 2, F.date_format(d, "yyyyMMdd"))
        .when(k == 3, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.lit(""))
    )
    whole = F.date_format(d, "yyyyMMdd").cast("int")
    texts = table(spark, folder, "orders").select("o_orderkey", text.alias("as_text"), whole.alias("as_number"))
    parsed = parse_dates(texts, ["as_text", "as_number"])
    days = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("as_text", "as_number")]
    return parsed.select("o_orderkey", *days)


def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    holed = holed_orders(spark, folder).select("o_orderkey", "o_totalprice")
    return rounded(fit_imputer(holed, ["o_totalprice"]).transform(holed), "o_totalprice")


def impute_mode(spark: SparkSession, folder: str) -> DataFrame:
    holed = holed_orders(spark, folder).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return fit_imputer(holed).transform(holed)


def _parts_twice(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_brand", "p_type", gap("p_partkey", 9, "p_size"))
    return part.unionByName(part)


PARTS_TWICE = """
SELECT p_brand, p_type, CASE WHEN p_partkey % 9 <> 0 THEN p_size END AS p_size FROM part
UNION ALL SELECT p_brand, p_type, CASE WHEN p_partkey % 9 <> 0 THEN p_size END AS p_size FROM part
"""


def dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    return drop_duplicate_rows(_parts_twice(spark, folder))


def dedupe_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(duplicate_report(_parts_twice(spark, folder)), "removed_ratio")


def _event_values(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", gap("event_id", 17, "value"))


def cap_iqr(spark: SparkSession, folder: str) -> DataFrame:
    events = _event_values(spark, folder)
    return rounded(fit_capper(events, ["value"], "iqr", 1.0).transform(events), "value")


def cap_zscore(spark: SparkSession, folder: str) -> DataFrame:
    events = _event_values(spark, folder)
    return rounded(fit_capper(events, ["value"], "zscore", 1.5).transform(events), "value")


def outlier_report(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    return rounded(fit_capper(orders, ["l_quantity", "l_extendedprice"], "iqr", 0.25).report(orders), "lower", "upper")


def _accounts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey", gap("c_custkey", 10, "c_acctbal"), "c_nationkey", F.lit(7.5).alias("constant")
    )


ACCOUNTS = """
SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS c_acctbal, c_nationkey, 7.5::DOUBLE AS constant
FROM customer
"""
SCALED = ["c_acctbal", "c_nationkey", "constant"]


def scale_standard(spark: SparkSession, folder: str) -> DataFrame:
    accounts = _accounts(spark, folder)
    return rounded(fit_scaler(accounts, SCALED).transform(accounts), *SCALED)


def scale_minmax(spark: SparkSession, folder: str) -> DataFrame:
    accounts = _accounts(spark, folder)
    return rounded(fit_scaler(accounts, SCALED, "minmax").transform(accounts), *SCALED)


def encode_onehot(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", gap("c_custkey", 6, "c_mktsegment"), "c_acctbal")
    return fit_onehot(customer, ["c_mktsegment"]).transform(customer)


def encode_label(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", gap("event_id", 8, "event_type"))
    return fit_label(events, ["event_type"], "event_id").transform(events)


def encode_label_wide(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", F.col("user_id").cast("string").alias("user_id"))
    return fit_label(events, ["user_id"], "event_id").transform(events)


def encode_label_huge(spark: SparkSession, folder: str) -> DataFrame:
    """The path for columns with too many values to broadcast."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    return fit_label(orders, ["customer"], "o_orderkey", broadcast_levels=10).transform(orders)


def _composite(spark: SparkSession, folder: str, broadcast_levels: int) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return fit_label(lines, ["part"], ["l_orderkey", "l_linenumber"], broadcast_levels).transform(lines)


def label_composite_key(spark: SparkSession, folder: str) -> DataFrame:
    """Codes in a table, by a key of two columns."""
    return _composite(spark, folder, 10)


def label_composite_small(spark: SparkSession, folder: str) -> DataFrame:
    """The same codes in a list."""
    return _composite(spark, folder, 10_000_000)


def onehot_wide(spark: SparkSession, folder: str) -> DataFrame:
    """More values than columns are wanted for: one sparse vector."""
    customer = table(spark, folder, "customer").select("c_custkey", gap("c_custkey", 6, "c_nationkey"))
    vectors = fit_onehot(customer, ["c_nationkey"], dense_levels=10).transform(customer)
    place = F.coalesce(F.get("c_nationkey_onehot.indices", F.lit(0)), F.lit(-1)).cast("long")
    return vectors.select("c_custkey", F.col("c_nationkey_onehot.size").alias("width"), place.alias("place"))


def csv_roundtrip_text(spark: SparkSession, folder: str) -> DataFrame:
    """Long texts with quotes and line breaks."""
    path = scratch_path(spark) + ".csv"
    write_csv(table(spark, folder, "documents").select("doc_id", "text", "lang"), path)
    return read_csv(spark, path)


def _raw_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Cases as they come from a file: untidy names, dates as text, gaps and repeated rows."""
    c = cases(spark, folder).select(
        F.col("o_orderkey").alias("Order Key"),
        gap("o_orderkey", 7, "o_totalprice").alias("Total Price"),
        gap("o_orderkey", 11, "o_orderstatus").alias("Order-Status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order Date"),
        F.col("o_orderpriority").alias("Priority"),
        F.col("c_acctbal").alias("Acct Bal!"),
        gap("o_orderkey", 5, "c_mktsegment").alias("Segment"),
    )
    return c.unionByName(c.where(F.col("Order Key") % 10 == 0))


PREPROCESS_SPEC = PipelineSpec(
    target_column="Priority",
    key_columns=["Order Key"],
    numeric_columns=["Total Price", "Acct Bal!"],
    categorical_columns=["Order-Status", "Segment"],
    date_columns=["Order Date"],
    handle_outliers_cols=["Total Price", "Acct Bal!"],
    outlier_threshold=0.4,
)


def preprocess_full(spark: SparkSession, folder: str) -> DataFrame:
    _, done = fit_preprocessing(_raw_cases(spark, folder), PREPROCESS_SPEC)
    dated = done.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))
    return rounded(dated, "total_price", "acct_bal")


RAW_CASES = f"""
SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS total_price,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
  o_orderpriority AS priority, c_acctbal AS acct_bal,
  CASE WHEN o_orderkey % 5 <> 0 THEN c_mktsegment END AS segment
FROM ({CASES})
"""


def _dummy(column: str, value: str, name: str) -> str:
    return f"CASE WHEN {column} = '{value}' THEN 1 ELSE 0 END::INTEGER AS \"{name}_{value}\""


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
STATUSES = ["F", "O", "P"]
# Here and below: sums of floats are compared after rounding, because their order of addition differs.
PREPROCESS_SQL = f"""
WITH raw AS ({RAW_CASES}), doubled AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE order_key % 10 = 0),
med AS (SELECT quantile_cont(total_price, 0.5) AS m FROM doubled),
st AS (SELECT orderstatus AS v FROM doubled WHERE orderstatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
sg AS (SELECT segment AS v FROM doubled WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
filled AS (SELECT DISTINCT order_key, coalesce(total_price, m) AS total_price, coalesce(orderstatus, st.v) AS orderstatus,
  order_date, priority, acct_bal, coalesce(segment, sg.v) AS segment FROM doubled, med, st, sg),
q AS (SELECT quantile_cont(total_price, 0.25) AS t1, quantile_cont(total_price, 0.75) AS t3,
  quantile_cont(acct_bal, 0.25) AS a1, quantile_cont(acct_bal, 0.75) AS a3 FROM filled),
capped AS (SELECT order_key, order_date, priority, orderstatus, segment,
  greatest(t1 - 0.4 * (t3 - t1), least(t3 + 0.4 * (t3 - t1), total_price)) AS total_price,
  greatest(a1 - 0.4 * (a3 - a1), least(a3 + 0.4 * (a3 - a1), acct_bal)) AS acct_bal FROM filled, q),
s AS (SELECT avg(total_price) AS tm, stddev_pop(total_price) AS ts, avg(acct_bal) AS am, stddev_pop(acct_bal) AS asd FROM capped)
SELECT order_key, round((total_price - tm) / ts, 6) + 0.0 AS total_price, order_date, priority,
  round((acct_bal - am) / asd, 6) + 0.0 AS acct_bal,
  {', '.join(_dummy('orderstatus', v, 'orderstatus') for v in STATUSES)},
  {', '.join(_dummy('segment', v, 'segment') for v in SEGMENTS)}
FROM capped, s
"""

_EVENT_VALUES = "SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN value END AS value FROM events"

QUERIES = {
    "validate_profile": validate_profile,
    "features_check": features_check,
    "missing_report": missing_values,
    "clean_names": clean_names,
    "csv_roundtrip": csv_roundtrip,
    "csv_separator": csv_separator,
    "parse_dates": dates_parsed,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "dedupe_rows": dedupe_rows,
    "dedupe_report": dedupe_report,
    "cap_iqr": cap_iqr,
    "cap_zscore": cap_zscore,
    "outlier_report": outlier_report,
    "scale_standard": scale_standard,
    "scale_minmax": scale_minmax,
    "encode_onehot": encode_onehot,
    "onehot_wide": onehot_wide,
    "label_composite_key": label_composite_key,
    "label_composite_small": label_composite_small,
    "csv_roundtrip_text": csv_roundtrip_text,
    "encode_label": encode_label,
    "encode_label_wide": encode_label_wide,
    "encode_label_huge": encode_label_huge,
    "preprocess_full": preprocess_full,
}

_COMPOSITE = """
WITH f AS (SELECT l_partkey, min((l_orderkey, l_linenumber)) AS first FROM (SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem) GROUP BY 1),
c AS (SELECT l_partkey, row_number() OVER (ORDER BY first, l_partkey::VARCHAR) - 1 AS code FROM f)
SELECT l_orderkey, l_linenumber, code AS part FROM lineitem JOIN c USING (l_partkey)"""

ORACLES = {
    "validate_profile": f"""
WITH t AS ({HOLED_ORDERS})
SELECT count(*) AS n_rows, 6::BIGINT AS n_cols,
  (3 * count(*) - count(o_orderstatus) - count(o_totalprice) - count(o_orderpriority))::BIGINT AS null_cells,
  round((3 * count(*) - count(o_orderstatus) - count(o_totalprice) - count(o_orderpriority))::DOUBLE / (6 * count(*)), 6)
    + 0.0 AS missing_ratio
FROM t""",
    "features_check": f"""
WITH t AS ({HOLED_ORDERS})
SELECT count(*) AS n_rows, (count(*) - count(o_totalprice))::BIGINT AS missing_features,
  (count(*) - count(o_orderpriority))::BIGINT AS missing_targets FROM t""",
    "missing_report": f"""
WITH t AS ({HOLED_ORDERS})
SELECT 'o_orderstatus' AS "column", (count(*) - count(o_orderstatus))::BIGINT AS n_missing,
  round((count(*) - count(o_orderstatus))::DOUBLE / count(*), 6) AS missing_ratio FROM t
UNION ALL SELECT 'o_totalprice', (count(*) - count(o_totalprice))::BIGINT,
  round((count(*) - count(o_totalprice))::DOUBLE / count(*), 6) FROM t
UNION ALL SELECT 'o_orderpriority', (count(*) - count(o_orderpriority))::BIGINT,
  round((count(*) - count(o_orderpriority))::DOUBLE / count(*), 6) FROM t""",
    "clean_names": """
SELECT c_custkey, c_name AS cname_full, c_nationkey AS nationkey, c_acctbal AS acct_bal, c_mktsegment AS "시장_구분"
FROM customer""",
    "csv_roundtrip": """
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS c_name,
  CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS c_acctbal,
  'say "' || c_mktsegment || '", twice' AS quoted, c_nationkey % 2 = 0 AS even FROM customer""",
    "onehot_wide": """
WITH l AS (SELECT DISTINCT c_nationkey AS v FROM customer WHERE c_custkey % 6 <> 0),
r AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place FROM l)
SELECT c_custkey, (SELECT count(*) FROM l)::INTEGER AS width,
  CASE WHEN c_custkey % 6 <> 0 THEN place ELSE -1 END::BIGINT AS place
FROM customer LEFT JOIN r ON c_nationkey = v""",
    "label_composite_key": _COMPOSITE,
    "label_composite_small": _COMPOSITE,
    "csv_roundtrip_text": "SELECT doc_id, text, lang FROM documents",
    "csv_separator": "SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier",
    "parse_dates": """
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 1 THEN strftime(o_orderdate, '%Y-%-m-%-d') WHEN 2 THEN strftime(o_orderdate, '%Y%m%d')
  WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' ELSE '' END AS x,
  strftime(o_orderdate, '%Y%m%d') AS y FROM orders)
SELECT o_orderkey, strftime(try_strptime(x, '%Y-%m-%d'), '%Y-%m-%d') AS as_text,
  strftime(try_strptime(y, '%Y-%m-%d'), '%Y-%m-%d') AS as_number FROM t""",
    "impute_median": f"""
WITH t AS ({HOLED_ORDERS}), m AS (SELECT quantile_cont(o_totalprice, 0.5) AS m FROM t)
SELECT o_orderkey, round(coalesce(o_totalprice, m), 6) + 0.0 AS o_totalprice FROM t, m""",
    "impute_mode": f"""
WITH t AS ({HOLED_ORDERS}),
a AS (SELECT o_orderstatus AS v FROM t WHERE o_orderstatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
b AS (SELECT o_orderpriority AS v FROM t WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, coalesce(o_orderstatus, a.v) AS o_orderstatus, coalesce(o_orderpriority, b.v) AS o_orderpriority
FROM t, a, b""",
    "dedupe_rows": f"SELECT DISTINCT * FROM ({PARTS_TWICE})",
    "dedupe_report": f"""
WITH t AS ({PARTS_TWICE}), d AS (SELECT count(*) AS k FROM (SELECT DISTINCT * FROM t)), n AS (SELECT count(*) AS n FROM t)
SELECT n AS n_rows, k AS n_kept, n - k AS n_removed, round((n - k)::DOUBLE / n, 6) + 0.0 AS removed_ratio FROM n, d""",
    "cap_iqr": f"""
WITH t AS ({_EVENT_VALUES}),
q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM t)
SELECT event_id, round(CASE WHEN value IS NULL THEN NULL WHEN value < a - (b - a) THEN a - (b - a)
  WHEN value > b + (b - a) THEN b + (b - a) ELSE value END, 6) + 0.0 AS value FROM t, q""",
    "cap_zscore": f"""
WITH t AS ({_EVENT_VALUES}), q AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM t)
SELECT event_id, round(CASE WHEN value IS NULL THEN NULL WHEN value < m - 1.5 * s THEN m - 1.5 * s
  WHEN value > m + 1.5 * s THEN m + 1.5 * s ELSE value END, 6) + 0.0 AS value FROM t, q""",
    "outlier_report": """
WITH t AS (SELECT 'l_quantity' AS c, l_quantity AS v FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem),
q AS (SELECT c, quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM t GROUP BY c),
w AS (SELECT c, a - 0.25 * (b - a) AS lo, b + 0.25 * (b - a) AS hi FROM q)
SELECT t.c AS "column", round(min(lo), 6) + 0.0 AS lower, round(min(hi), 6) + 0.0 AS upper,
  count(*) FILTER (WHERE v < lo OR v > hi) AS n_outliers FROM t JOIN w ON t.c = w.c GROUP BY t.c""",
    "scale_standard": f"""
WITH t AS ({ACCOUNTS}), s AS (SELECT avg(c_acctbal) AS m1, stddev_pop(c_acctbal) AS d1, avg(c_nationkey) AS m2,
  stddev_pop(c_nationkey) AS d2 FROM t)
SELECT c_custkey, round((c_acctbal - m1) / d1, 6) + 0.0 AS c_acctbal, round((c_nationkey - m2) / d2, 6) + 0.0 AS c_nationkey,
  0.0::DOUBLE AS constant FROM t, s""",
    "scale_minmax": f"""
WITH t AS ({ACCOUNTS}), s AS (SELECT min(c_acctbal) AS a1, max(c_acctbal) AS b1, min(c_nationkey) AS a2,
  max(c_nationkey) AS b2 FROM t)
SELECT c_custkey, round((c_acctbal - a1) / (b1 - a1), 6) + 0.0 AS c_acctbal,
  round((c_nationkey - a2)::DOUBLE / (b2 - a2), 6) + 0.0 AS c_nationkey, 0.0::DOUBLE AS constant FROM t, s""",
    "encode_onehot": f"""
WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS m, c_acctbal FROM customer)
SELECT c_custkey, c_acctbal, {', '.join(_dummy('m', v, 'c_mktsegment') for v in SEGMENTS)} FROM t""",
    "encode_label": """
WITH t AS (SELECT event_id, CASE WHEN event_id % 8 <> 0 THEN event_type END AS v FROM events),
f AS (SELECT v, min(event_id) AS f FROM t WHERE v IS NOT NULL GROUP BY v),
c AS (SELECT v, row_number() OVER (ORDER BY f) - 1 AS code FROM f)
SELECT event_id, coalesce(code, -1)::BIGINT AS event_type FROM t LEFT JOIN c ON t.v = c.v""",
    "encode_label_wide": """
WITH f AS (SELECT user_id, min(event_id) AS f FROM events GROUP BY user_id),
c AS (SELECT user_id, row_number() OVER (ORDER BY f) - 1 AS code FROM f)
SELECT event_id, code::BIGINT AS user_id FROM events e JOIN c ON e.user_id = c.user_id""",
    "encode_label_huge": """
WITH f AS (SELECT o_custkey, min(o_orderkey) AS f FROM orders GROUP BY o_custkey),
c AS (SELECT o_custkey, row_number() OVER (ORDER BY f) - 1 AS code FROM f)
SELECT o_orderkey, code::BIGINT AS customer FROM orders o JOIN c ON o.o_custkey = c.o_custkey""",
    "preprocess_full": PREPROCESS_SQL,
}
