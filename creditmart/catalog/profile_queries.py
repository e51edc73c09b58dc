"""Aggregations, quantiles and profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditmart.catalog import tables as T
from creditmart.catalog.registry import query
from creditmart.functions.arrays import split_list
from creditmart.operators import encoding, profile, states
from creditmart.operators.quantiles import Quantile, approx_quantiles, exact_quantiles, quantile_frame
from creditmart.session import materialized
from creditmart.sources.datamart import Datamart
from creditmart.sources.schemas import CLICKSTREAM_FEATURES

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _rounded(df: DataFrame, scale: int = 6) -> DataFrame:
    """Floating sums depend on the order of rows; compare what is left after rounding."""
    return df.select(*[F.round(c, scale).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "lineitem").select(*MEASURES)


@query("SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.distinct_values(T.table(spark, sf_dir, "orders"), "o_orderpriority")


@query("SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part")
def array_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = T.table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("word"))
    return encoding.array_vocabulary(words, "word")


def _profile_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS "count", count(*) - count({c}) AS null_count,
    round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
    round(min(CAST({c} AS DOUBLE)), 6) AS "min", round(max(CAST({c} AS DOUBLE)), 6) AS "max", round(avg(pow({c} - m, 3)) / nullif(pow(avg(pow({c} - m, 2)), 1.5), 0), 6) AS skewness,
    round(avg(pow({c} - m, 4)) / nullif(pow(avg(pow({c} - m, 2)), 2), 0) - 3, 6) AS kurtosis,
    round(CAST(quantile_disc({c}, 0.5) AS DOUBLE), 6) AS median FROM src, (SELECT avg({c}) AS m FROM src)"""


PROFILED = ("tenure", "installment_num", "loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance")


@query(
    T.with_views("ledger")
    + f", src AS (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in PROFILED)} FROM ledger) "
    + " UNION ALL ".join(_profile_sql(c) for c in PROFILED)
)
def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.numeric_profile(materialized(T.ledger(spark, sf_dir).select(*PROFILED))))


def _states_sql(c: str) -> str:
    rows = f"SELECT snapshot_date, CAST({c} AS DOUBLE) AS v FROM ledger UNION ALL SELECT NULL, CAST({c} AS DOUBLE) FROM ledger"
    return f"""SELECT snapshot_date, '{c}' AS "column", count(v) AS "count", count(*) - count(v) AS null_count, round(avg(v), 4) AS mean,
    round(stddev_samp(v), 4) AS stddev, round(min(v), 4) AS "min", round(max(v), 4) AS "max",
    round(avg(pow(v - m, 3)) / nullif(pow(avg(pow(v - m, 2)), 1.5), 0), 4) AS skewness,
    round(avg(pow(v - m, 4)) / nullif(pow(avg(pow(v - m, 2)), 2), 0) - 3, 4) AS kurtosis
    FROM (SELECT *, avg(v) OVER (PARTITION BY snapshot_date) AS m FROM ({rows})) GROUP BY snapshot_date"""


@query(T.with_views("ledger") + " UNION ALL ".join(_states_sql(c) for c in PROFILED))
def profile_by_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of each month, and of all months (no date), from states kept by month: two runs add their months each."""
    mart, ledger = Datamart(spark, T.scratch_root(spark)), T.ledger(spark, sf_dir)
    early = F.col("snapshot_date") < F.lit("1995-01-01").cast("date")
    for part in (early, ~early):
        mart.write(states.moments(ledger.where(part), PROFILED), "profile", "ledger")
    kept = mart.read("profile", "ledger")
    monthly = states.profile_of(kept, ["snapshot_date"])
    whole = states.profile_of(states.merged(kept)).withColumn("snapshot_date", F.lit(None).cast("date"))
    return _rounded(monthly.unionByName(whole), 4)


@query(
    T.with_views("ledger")
    + ", ledger_range AS (SELECT * FROM ledger WHERE snapshot_date BETWEEN DATE '1994-03-01' AND DATE '1996-10-01') "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{n}' AS name, count({c}) AS n, CAST(quantile_disc({c}, {low}) AS DOUBLE) AS low,
        CAST(quantile_disc({c}, {high}) AS DOUBLE) AS high, true AS in_range FROM ledger_range"""
        for c in ("loan_amt", "due_amt", "paid_amt", "balance")
        for n, (low, high) in {"p50": (0.49, 0.51), "p95": (0.94, 0.96)}.items()
    )
)
def sketch_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of a range of months from a sketch for each month, merged on read; checked between exact ones."""
    mart, measures = Datamart(spark, T.scratch_root(spark)), ("loan_amt", "due_amt", "paid_amt", "balance")
    ledger = materialized(T.ledger(spark, sf_dir).select("snapshot_date", *measures))  # one join for the sketches and all passes
    mart.write(states.sketches(ledger, measures), "sketches", "ledger")
    months = "snapshot_date BETWEEN DATE '1994-03-01' AND DATE '1996-10-01'"
    found = states.quantiles_of(states.merged_sketches(mart.read("sketches", "ledger").where(months)), {"p50": 0.5, "p95": 0.95})
    ends = {"p50": (0.49, 0.51), "p95": (0.94, 0.96)}
    exact = exact_quantiles(ledger.where(months), [Quantile(c, p, f"{c}.{n}.{i}") for c in measures for n, e in ends.items() for i, p in enumerate(e)])
    rows = [(c, n, exact[f"{c}.{n}.0"], exact[f"{c}.{n}.1"]) for c in measures for n in ends]
    limits = spark.createDataFrame(rows, "`column` string, name string, low double, high double")
    named = found.select("column", "n", F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in ends])))
    return named.join(F.broadcast(limits), ["column", "name"]).select("column", "name", "n", "low", "high", F.col("value").between(F.col("low"), F.col("high")).alias("in_range"))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, min({c}) AS "min", round(quantile_cont({c}, 0.25), 6) AS p25,
        round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS "max"
        FROM lineitem"""
        for c in MEASURES
    )
)
def describe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.describe(_measures(spark, sf_dir)))


@query(
    T.with_views("attributes")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS non_null, '{t}' AS dtype FROM attributes"
        for c, t in {**dict.fromkeys(T.ATTRIBUTES, "string"), "snapshot_date": "date"}.items()
    )
)
def column_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_info(T.attributes(spark, sf_dir))


WANTED = (("o_totalprice", 0.5), ("o_totalprice", 0.95), ("o_totalprice", 0.997), ("o_custkey", 0.95))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS p, CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM orders"
        for c, p in WANTED
    )
)
def quantile_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantile_frame(T.table(spark, sf_dir, "orders"), [Quantile(c, p, f"{c}.{p}") for c, p in WANTED])


# A sketch's value is not determined by the data alone: what is compared is that it lies between the exact quantiles at the
# ends of the promised error, and these quantiles.
def _range_sql(column: str, table: str, name: str, low: float, high: float) -> str:
    return f"""SELECT '{name}' AS name, CAST(quantile_disc({column}, {low}) AS DOUBLE) AS low,
    CAST(quantile_disc({column}, {high}) AS DOUBLE) AS high, true AS in_range FROM {table}"""


def _in_range(df: DataFrame, column: str, sketched: DataFrame, ends: dict[str, tuple[float, float]]) -> DataFrame:
    """Per name: the exact quantiles of both ends, and whether the sketch's value of that name lies between them."""
    wanted = [Quantile(column, p, f"{n}.{side}") for n, pair in ends.items() for side, p in zip(("low", "high"), pair)]
    exact = exact_quantiles(df, wanted)
    entries = [
        F.struct(
            F.lit(n).alias("name"), F.lit(exact[f"{n}.low"]).cast("double").alias("low"),
            F.lit(exact[f"{n}.high"]).cast("double").alias("high"),
            F.col(n).between(exact[f"{n}.low"], exact[f"{n}.high"]).alias("in_range"),
        )
        for n in ends
    ]
    return sketched.select(F.inline(F.array(*entries)))


PRICE_ENDS = {"p50": (0.49, 0.51), "p95": (0.94, 0.96), "p997": (0.987, 1.0)}


@query(" UNION ALL ".join(_range_sql("o_totalprice", "orders", n, *ends) for n, ends in PRICE_ENDS.items()))
def quantile_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T.table(spark, sf_dir, "orders")
    points = {"p50": 0.5, "p95": 0.95, "p997": 0.997}
    sketched = approx_quantiles(orders, [Quantile("o_totalprice", p, n) for n, p in points.items()], 0.01)
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in sketched.items()])
    return _in_range(orders, "o_totalprice", row, PRICE_ENDS)


MEDIAN_ENDS = {"median": (0.499, 0.501)}


@query(_range_sql("l_extendedprice", "lineitem", "median", *MEDIAN_ENDS["median"]))
def median_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _measures(spark, sf_dir)
    median = rows.agg(F.percentile_approx("l_extendedprice", 0.5).alias("median"))
    return _in_range(rows, "l_extendedprice", median, MEDIAN_ENDS)


@query(
    """SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type ORDER BY 2 DESC, 1"""
)
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(T.table(spark, sf_dir, "events"), "event_type")


@query(
    """SELECT quality, count(*) AS "count", round(count(*) * 100.0 / (SELECT count(quality) FROM labels), 6) AS pct
    FROM labels WHERE quality IS NOT NULL GROUP BY quality"""
)
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.value_counts(T.table(spark, sf_dir, "labels"), "quality", normalize=True, keep_null=False))


def _corr_sql(where: str, columns: str = "a, b, r, i, j") -> str:
    pairs = [
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r, {i} AS i, {j} AS j FROM lineitem"
        for i, a in enumerate(MEASURES)
        for j, b in enumerate(MEASURES)
        if i != j
    ]
    same = [f"SELECT '{a}', '{a}', 1.0::DOUBLE, {i}, {i}" for i, a in enumerate(MEASURES)]
    return f"SELECT {columns} FROM ({' UNION ALL '.join(pairs + same)}) {where}"


@query(_corr_sql(""))
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.correlations(_measures(spark, sf_dir)))


@query(
    T.with_views("clickstream")
    + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS r FROM clickstream"
        for a, b in combinations(CLICKSTREAM_FEATURES, 2)
    )
    + ") WHERE abs(r) > 0.7"
)
def high_corr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.high_correlations(profile.correlations(T.clickstream(spark, sf_dir), CLICKSTREAM_FEATURES), 0.7))


GAPPED = ", ".join(
    f"CASE WHEN CAST(fe_15 AS INT) % {i + 3} = 0 THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}" for i, c in enumerate(CLICKSTREAM_FEATURES)
)


@query(
    T.with_views("clickstream")
    + f", gapped AS (SELECT {GAPPED} FROM clickstream) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM gapped" for a, b in combinations(CLICKSTREAM_FEATURES, 2)
    )
)
def corr_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty columns, each with its own gaps: a pair is measured where both are known."""
    gapped = T.clickstream(spark, sf_dir).selectExpr(*GAPPED.replace(", CASE", "|CASE").split("|"))
    return _rounded(profile.correlations(gapped).where("i < j").select("a", "b", "r"))


@query(_corr_sql("WHERE j < i"))
def corr_lower_triangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.lower_triangle(profile.correlations(_measures(spark, sf_dir))))


@query(_corr_sql(""))
def corr_matrix_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.correlation_matrix(_measures(spark, sf_dir), MEASURES))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", b.k AS bin, round(lo + b.k * ((hi - lo) / 12), 6) AS lower,
        round(lo + (b.k + 1) * ((hi - lo) / 12), 6) AS upper, count(v.bin) AS n
        FROM (SELECT CAST(unnest(range(12)) AS INTEGER) AS k) b CROSS JOIN
        (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) s
        LEFT JOIN (SELECT least(CAST(floor(({c} - lo) / (hi - lo) * 12) AS INTEGER), 11) AS bin
        FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem)) v ON v.bin = b.k
        GROUP BY b.k, lo, hi"""
        for c in ("l_extendedprice", "l_quantity")
    )
)
def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.histogram(_measures(spark, sf_dir), ["l_extendedprice", "l_quantity"], bins=12))


def _density_sql(c: str, points: int) -> str:
    return f"""WITH s AS (SELECT count({c}) AS n, stddev_samp({c}) AS sd, min({c}) AS lo, max({c}) AS hi FROM lineitem),
    w AS (SELECT *, sd * pow(n, -0.2) AS h FROM s),
    g AS (SELECT lo - 3 * h + k * ((hi - lo + 6 * h) / {points - 1}) AS x, n, h
    FROM w, (SELECT unnest(range({points})) AS k)),
    v AS (SELECT {c} AS v, count(*) AS c FROM lineitem GROUP BY 1)
    SELECT '{c}' AS "column", round(x, 6) AS x,
    round(sum(c * exp(-0.5 * pow((x - v) / h, 2))) / (n * h * sqrt(2 * pi())), 6) AS density FROM g, v GROUP BY x, n, h"""


@query(f"SELECT x, density FROM ({_density_sql('l_quantity', 100)})")
def kde_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile.density(_measures(spark, sf_dir), "l_quantity", points=100))


SHAPED = ("l_quantity", "l_discount", "l_tax")


@query(
    "SELECT 'density' AS kind, * FROM ("
    + " UNION ALL ".join(f"SELECT * FROM ({_density_sql(c, 50)})" for c in SHAPED)
    + ") UNION ALL SELECT 'bin' AS kind, * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(lo + b.k * ((hi - lo) / 7), 6) AS x, CAST(count(v.bin) AS DOUBLE) AS density
        FROM (SELECT CAST(unnest(range(7)) AS INTEGER) AS k) b CROSS JOIN
        (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) s
        LEFT JOIN (SELECT least(CAST(floor(({c} - lo) / (hi - lo) * 7) AS INTEGER), 6) AS bin
        FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem)) v ON v.bin = b.k GROUP BY b.k, lo, hi"""
        for c in SHAPED
    )
    + ") UNION ALL SELECT 'median' AS kind, * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS x, CAST(count({c}) AS DOUBLE) AS density FROM lineitem"
        for c in SHAPED
    )
    + ")"
)
def distribution_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables in one, long: curves, counts per bin, and medians with counts."""
    found = profile.distributions(_measures(spark, sf_dir), SHAPED, bins=7, points=50)
    curves = found["densities"].select(F.lit("density").alias("kind"), "column", "x", "density")
    counts = found["bins"].select(F.lit("bin"), "column", "lower", F.col("n").cast("double"))
    medians = found["statistics"].select(F.lit("median"), "column", "median", F.col("count").cast("double"))
    return _rounded(curves.union(counts).union(medians))


@query(
    T.with_views("financials")
    + """SELECT DISTINCT item FROM (
    SELECT trim(unnest(string_split(replace(Type_of_Loan, ' and ', ', '), ','))) AS item FROM financials)
    WHERE item <> '' UNION SELECT 'No loan' FROM financials
    WHERE trim(coalesce(Type_of_Loan, '')) = ''"""
)
def loan_type_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = T.financials(spark, sf_dir).select(split_list(F.col("Type_of_Loan")).alias("item"))
    return encoding.array_vocabulary(items, "item")


