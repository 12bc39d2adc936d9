"""Feature construction, reduction and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.catalogue.tables import CASES, RATED_DOCUMENTS, cases, gap, rounded, table, written_documents
from tabwright.functions.stage import scratch_path
from tabwright.operators.features import add_polynomials, date_parts, fit_interactions
from tabwright.operators.reduce import fit_components
from tabwright.operators.select import anova_scores as anova
from tabwright.operators.select import fit_selection
from tabwright.plans.featurise import FittedFeatures, fit_features
from tabwright.spec import PipelineSpec


def feat_interaction(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity", "l_tax")
    return fit_interactions(lines, [("l_extendedprice", "l_quantity"), ("l_quantity", "l_tax")]).transform(lines)


def feat_ratio_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Discounts hold zeros and the gapped quantity misses values: neither gets a ratio, the plain quantity does."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_quantity", "l_discount", gap("l_orderkey", 3, "l_partkey")
    )
    pairs = [("l_extendedprice", "l_discount"), ("l_quantity", "l_partkey"), ("l_discount", "l_quantity")]
    return fit_interactions(lines, pairs).transform(lines)


def feat_polynomial(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_size", (F.col("p_retailprice") / 1000).alias("p_retailprice"))
    return add_polynomials(part, ["p_size", "p_retailprice"], 3)


def feat_dates(spark: SparkSession, folder: str) -> DataFrame:
    return date_parts(table(spark, folder, "orders").select("o_orderkey", gap("o_orderkey", 9, "o_orderdate")), ["o_orderdate"])


def _line_figures(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") / 1000).alias("price")
    )


def pca_scores(spark: SparkSession, folder: str) -> DataFrame:
    lines = _line_figures(spark, folder)
    return rounded(fit_components(lines, ["l_quantity", "price"], 1).transform(lines), "PC1")


def pca_variance(spark: SparkSession, folder: str) -> DataFrame:
    lines = _line_figures(spark, folder)
    return rounded(fit_components(lines, ["l_quantity", "price"], 1).variance_table(lines), "ratio", "cumulative")


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def anova_scores(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return rounded(fit_selection(lines, LINE_NUMBERS, "l_returnflag", 2).score_table(lines), "score", places=5)


def select_k_best(spark: SparkSession, folder: str) -> DataFrame:
    """Two features follow the class, the others (one of them constant) do not."""
    code = F.ascii("l_returnflag").cast("double")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_quantity",
        (code + F.col("l_discount")).alias("near"),
        F.lit(1.5).alias("constant"),
        "l_tax",
        (code * code + F.col("l_quantity")).alias("far"),
        "l_returnflag",
    )
    candidates = ["l_quantity", "near", "constant", "l_tax", "far"]
    return fit_selection(lines, candidates, "l_returnflag", 2).transform(lines, ["l_orderkey"])


DOCUMENT_NUMBERS = ["chars", "words", "lines"]


def mutual_information(spark: SparkSession, folder: str) -> DataFrame:
    documents = written_documents(spark, folder)
    return rounded(fit_selection(documents, DOCUMENT_NUMBERS, "lang", 2, "mutual_info").score_table(documents), "score", places=5)


FEATURE_SPEC = PipelineSpec(
    target_column="o_orderpriority",
    key_columns=["o_orderkey"],
    numeric_columns=["o_totalprice", "c_acctbal", "c_nationkey"],
    date_columns=["o_orderdate"],
    interaction_features=["c_acctbal", "o_totalprice"],
    polynomial_features=["o_totalprice", "c_acctbal"],
    n_select_features=6,
)


def feature_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Ratio, polynomials, date parts and the six best by F score; the score order is fixed by the data."""
    c = cases(spark, folder).drop("o_orderstatus", "c_mktsegment")
    scaled = c.withColumn("o_totalprice", F.col("o_totalprice") / 1e5).withColumn("c_acctbal", F.col("c_acctbal") / 1e3)
    fitted = fit_features(scaled, FEATURE_SPEC)
    table_ = fitted.selection.score_table(scaled)
    return rounded(table_, "score", places=4)


def feature_full(spark: SparkSession, folder: str) -> DataFrame:
    """The transformed table of the same job without selection and reduction."""
    c = cases(spark, folder).select("o_orderkey", "o_totalprice", "c_acctbal", "o_orderdate", "o_orderpriority")
    scaled = c.withColumn("o_totalprice", F.col("o_totalprice") / 1e5).withColumn("c_acctbal", F.col("c_acctbal") / 1e3)
    spec = PipelineSpec(**{**FEATURE_SPEC.__dict__, "n_select_features": None})
    return fit_features(scaled, spec).transform(scaled)


def feature_job(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job: built features, one component of the two amounts, and the five best by F score, fitted, written, read
    and applied; a row for each key and chosen feature."""
    c = cases(spark, folder).select("o_orderkey", "o_totalprice", "c_acctbal", "o_orderdate", "o_orderpriority")
    scaled = c.withColumn("o_totalprice", F.col("o_totalprice") / 1e5).withColumn("c_acctbal", F.col("c_acctbal") / 1e3)
    settings = {"numeric_columns": ["o_totalprice", "c_acctbal"], "pca_components": 1, "n_select_features": 5}
    path = scratch_path(spark)
    fit_features(scaled, PipelineSpec(**{**FEATURE_SPEC.__dict__, **settings})).write(spark, path)
    done = FittedFeatures.read(spark, path).transform(scaled)
    names = [n for n in done.columns if n not in ("o_orderkey", "o_orderpriority")]
    long = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").cast("double").alias("value")) for n in names]))
    return rounded(done.select("o_orderkey", long.alias("f")).select("o_orderkey", "f.feature", "f.value"), "value", places=6)


def anova_many_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One F statistic over as many classes as there are customers with orders."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_totalprice")
    score = anova(orders, ["o_totalprice"], "o_custkey")["o_totalprice"]
    return rounded(spark.createDataFrame([("o_totalprice", score)], "feature string, score double"), "score")


QUERIES = {
    "anova_many_classes": anova_many_classes,
    "feat_interaction": feat_interaction,
    "feat_ratio_guard": feat_ratio_guard,
    "feat_polynomial": feat_polynomial,
    "feat_dates": feat_dates,
    "pca_scores": pca_scores,
    "pca_variance": pca_variance,
    "anova_scores": anova_scores,
    "select_k_best": select_k_best,
    "mutual_information": mutual_information,
    "feature_scores": feature_scores,
    "feature_full": feature_full,
    "feature_job": feature_job,
}

# Two features have a closed form: the larger eigenvalue and its vector, signed so its larger entry is positive.
PCA_SQL = """
t AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem),
m AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS sxx, var_samp(y) AS syy, covar_samp(x, y) AS sxy FROM t),
e AS (SELECT *, ((sxx + syy) + sqrt((sxx - syy) ** 2 + 4 * sxy * sxy)) / 2 AS l1 FROM m),
v AS (SELECT *, CASE WHEN sxx >= syy THEN l1 - syy ELSE sxy END AS vx, CASE WHEN sxx >= syy THEN sxy ELSE l1 - sxx END AS vy FROM e),
u AS (SELECT *, sqrt(vx * vx + vy * vy) * CASE WHEN abs(vx) >= abs(vy) THEN sign(vx) ELSE sign(vy) END AS n FROM v)"""


def _anova(source: str, key: str, columns: list[str], chosen: int, target: str, places: int) -> str:
    """F statistic per column in SQL; ``source`` must provide the columns and the class."""
    longs = " UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS pos, {target} AS k, (\"{c}\")::DOUBLE AS v FROM s" for i, c in enumerate(columns))
    return f"""
WITH s AS ({source}), l AS ({longs}),
g AS (SELECT feature, pos, k, count(*) AS n, avg(v) AS m, var_pop(v) AS w FROM l GROUP BY ALL),
a AS (SELECT feature, avg(v) AS mu FROM l GROUP BY feature),
f AS (SELECT g.feature, any_value(pos) AS pos, CASE WHEN sum(n * w) > 0 THEN
  (sum(n * (m - mu) ** 2) / (count(*) - 1)) / (sum(n * w) / (sum(n) - count(*))) END AS score
  FROM g JOIN a ON g.feature = a.feature GROUP BY g.feature),
r AS (SELECT *, row_number() OVER (ORDER BY score DESC NULLS LAST, pos DESC) AS rk FROM f)
SELECT feature, round(score, {places}) + 0.0 AS score, rk <= {chosen} AS selected FROM r"""


_EDGES = ", ".join(f"quantile_cont(v, {i / 10}) AS e{i}" for i in range(1, 10))
_BIN = " + ".join(f"(v > e{i})::INT" for i in range(1, 10))
MUTUAL_SQL = f"""
WITH d AS ({RATED_DOCUMENTS}),
l AS (SELECT 'chars' AS feature, lang, chars AS v FROM d UNION ALL SELECT 'words', lang, words FROM d
  UNION ALL SELECT 'lines', lang, lines FROM d),
q AS (SELECT feature, {_EDGES} FROM l GROUP BY feature),
u AS (SELECT feature, unnest([{', '.join(f'e{i}' for i in range(1, 10))}]) AS e FROM q),
x AS (SELECT DISTINCT feature, e FROM u),
b AS (SELECT l.feature, lang, v, (SELECT count(*) FROM x WHERE x.feature = l.feature AND l.v > x.e) AS bin FROM l),
c AS (SELECT feature, bin, lang, count(*) AS n FROM b GROUP BY ALL),
p AS (SELECT *, sum(n) OVER (PARTITION BY feature, bin) AS nb, sum(n) OVER (PARTITION BY feature, lang) AS nk,
  sum(n) OVER (PARTITION BY feature) AS nn FROM c),
f AS (SELECT feature, sum(n::DOUBLE / nn * ln(n::DOUBLE * nn / (nb * nk))) AS score FROM p GROUP BY feature),
r AS (SELECT *, row_number() OVER (ORDER BY score DESC) AS rk FROM f)
SELECT feature, round(score, 5) + 0.0 AS score, rk <= 2 AS selected FROM r"""

_DATE_PARTS = """year({0})::INTEGER AS {0}_year, month({0})::INTEGER AS {0}_month, day({0})::INTEGER AS {0}_day,
  (isodow({0}) - 1)::INTEGER AS {0}_dayofweek, quarter({0})::INTEGER AS {0}_quarter,
  coalesce((isodow({0}) >= 6)::INTEGER, 0)::INTEGER AS {0}_is_weekend"""
_BUILT = f"""
SELECT o_orderkey, t AS o_totalprice, a AS c_acctbal, c_nationkey, o_orderpriority, a * t AS c_acctbal_o_totalprice_interaction,
  a / t AS c_acctbal_to_o_totalprice_ratio, t * t AS "o_totalprice^2", t * a AS "o_totalprice c_acctbal", a * a AS "c_acctbal^2", {_DATE_PARTS.format('o_orderdate')}
FROM (SELECT *, o_totalprice / 1e5 AS t, c_acctbal / 1e3 AS a FROM ({CASES}))"""
_BUILT_NAMES = [
    "o_totalprice", "c_acctbal", "c_nationkey", "c_acctbal_o_totalprice_interaction", "c_acctbal_to_o_totalprice_ratio", "o_totalprice^2", "o_totalprice c_acctbal",
    "c_acctbal^2", "o_orderdate_year", "o_orderdate_month", "o_orderdate_day", "o_orderdate_dayofweek", "o_orderdate_quarter",
    "o_orderdate_is_weekend",
]

_PC1 = f"""
WITH t AS ({_BUILT}),
m AS (SELECT avg(o_totalprice) AS mx, avg(c_acctbal) AS my, var_samp(o_totalprice) AS sxx, var_samp(c_acctbal) AS syy,
  covar_samp(o_totalprice, c_acctbal) AS sxy FROM t),
e AS (SELECT *, ((sxx + syy) + sqrt((sxx - syy) ** 2 + 4 * sxy * sxy)) / 2 AS l1 FROM m),
v AS (SELECT *, CASE WHEN sxx >= syy THEN l1 - syy ELSE sxy END AS vx, CASE WHEN sxx >= syy THEN sxy ELSE l1 - sxx END AS vy FROM e),
u AS (SELECT *, sqrt(vx * vx + vy * vy) * CASE WHEN abs(vx) >= abs(vy) THEN sign(vx) ELSE sign(vy) END AS n FROM v)
SELECT t.*, (o_totalprice - mx) * vx / n + (c_acctbal - my) * vy / n AS "PC1" FROM t, u"""
_JOB_NAMES = [*[n for n in _BUILT_NAMES if n not in ("c_nationkey", "o_totalprice", "c_acctbal")], "PC1"]
_JOB_LONG = " UNION ALL ".join(f"SELECT o_orderkey, '{c}' AS feature, (\"{c}\")::DOUBLE AS value FROM ({_PC1})" for c in _JOB_NAMES)
_JOB_SQL = f"""
SELECT o_orderkey, feature, round(value, 6) + 0.0 AS value FROM ({_JOB_LONG})
WHERE feature IN (SELECT feature FROM ({_anova(_PC1, 'o_orderkey', _JOB_NAMES, 5, 'o_orderpriority', 9)}) WHERE selected)"""

ORACLES = {
    "anova_many_classes": """
WITH g AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders GROUP BY 1),
t AS (SELECT sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS grand FROM g)
SELECT 'o_totalprice' AS feature, round((sum(g.n * (m - grand) ** 2) / (any_value(k) - 1))
  / (sum(g.n * v) / (any_value(t.n) - any_value(k))), 6) + 0.0 AS score FROM g, t""",
    "feat_interaction": """
SELECT l_orderkey, l_extendedprice, l_quantity, l_tax,
  l_extendedprice * l_quantity AS l_extendedprice_l_quantity_interaction,
  l_extendedprice / l_quantity AS l_extendedprice_to_l_quantity_ratio,
  l_quantity * l_tax AS l_quantity_l_tax_interaction FROM lineitem""",
    "feat_ratio_guard": """
WITH t AS (SELECT l_orderkey, l_extendedprice, l_quantity, l_discount,
  CASE WHEN l_orderkey % 3 <> 0 THEN l_partkey END AS l_partkey FROM lineitem)
SELECT *, l_extendedprice * l_discount AS l_extendedprice_l_discount_interaction,
  l_quantity * l_partkey AS l_quantity_l_partkey_interaction,
  l_discount * l_quantity AS l_discount_l_quantity_interaction,
  l_discount / l_quantity AS l_discount_to_l_quantity_ratio FROM t""",
    "feat_polynomial": """
WITH t AS (SELECT p_partkey, p_size, p_retailprice / 1000 AS r, p_size::DOUBLE AS s FROM part)
SELECT p_partkey, p_size, r AS p_retailprice, s * s AS "p_size^2",
  s * r AS "p_size p_retailprice", r * r AS "p_retailprice^2",
  s * s * s AS "p_size^3", s * s * r AS "p_size^2 p_retailprice",
  s * r * r AS "p_size p_retailprice^2", r * r * r AS "p_retailprice^3" FROM t""",
    "feat_dates": f"""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS o_orderdate FROM orders)
SELECT o_orderkey, {_DATE_PARTS.format('o_orderdate')} FROM t""",
    "pca_scores": f"""
WITH {PCA_SQL} SELECT l_orderkey, l_linenumber, round((x - mx) * vx / n + (y - my) * vy / n, 6) + 0.0 AS "PC1" FROM t, u""",
    "pca_variance": f"""
WITH {PCA_SQL} SELECT 'PC1' AS component, round(l1 / (sxx + syy), 6) + 0.0 AS ratio,
  round(l1 / (sxx + syy), 6) + 0.0 AS cumulative FROM u""",
    "anova_scores": _anova("SELECT * FROM lineitem", "l_orderkey", LINE_NUMBERS, 2, "l_returnflag", 5),
    "select_k_best": """
SELECT l_orderkey, ascii(l_returnflag) + l_discount AS near, ascii(l_returnflag) * ascii(l_returnflag) + l_quantity AS far,
  l_returnflag FROM lineitem""",
    "mutual_information": MUTUAL_SQL,
    "feature_scores": _anova(_BUILT, "o_orderkey", _BUILT_NAMES, 6, "o_orderpriority", 4),
    "feature_full": f"SELECT * EXCLUDE (c_nationkey) FROM ({_BUILT})",
    "feature_job": _JOB_SQL,
}
