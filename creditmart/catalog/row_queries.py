"""Projections, filters, joins, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditmart.catalog import tables as T
from creditmart.catalog.registry import query
from creditmart.functions import arrays, text
from creditmart.functions.delinquency import at_least_flag
from creditmart.operators import cleaning, encoding, joins, schema
from creditmart.plans import gold, silver
from creditmart.session import materialized
from creditmart.sources import datamart as dm
from creditmart.sources.schemas import CLICKSTREAM_FEATURES, CLICKSTREAM_TYPES, LOAN_TYPES

DAY = "1998-06-01"
LOAN_KEY = ("loan_id", "installment_num", "snapshot_date")
KEYS_SQL = ", ".join(LOAN_KEY)


# Filters


@query(T.with_views("ledger") + f"SELECT {KEYS_SQL} FROM ledger WHERE snapshot_date = DATE '{DAY}'")
def filter_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dm.at_snapshot(T.ledger(spark, sf_dir), DAY).select(*LOAN_KEY)


@query(T.with_views("ledger") + f"SELECT {KEYS_SQL} FROM ledger WHERE snapshot_date <= DATE '{DAY}'")
def filter_upto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dm.up_to(T.ledger(spark, sf_dir), DAY).select(*LOAN_KEY)


@query(
    T.with_views("ledger")
    + f"SELECT {KEYS_SQL} FROM ledger WHERE snapshot_date >= DATE '1997-01-01' AND snapshot_date <= DATE '{DAY}'"
)
def filter_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dm.between(T.ledger(spark, sf_dir), "1997-01-01", DAY).select(*LOAN_KEY)


@query(T.with_views("loan_daily") + "SELECT loan_id, mob, dpd, snapshot_date FROM loan_daily WHERE mob = 6")
def filter_mob(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = silver.loan_daily(T.ledger(spark, sf_dir))
    return loans.where(F.col("mob") == 6).select("loan_id", "mob", "dpd", "snapshot_date")


@query(
    T.with_views("ledger")
    + f"SELECT {KEYS_SQL}, loan_start_date FROM ledger WHERE loan_start_date < DATE '1998-01-01'"
)
def filter_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.lit("1998-01-01").cast("date")
    return T.ledger(spark, sf_dir).where(F.col("loan_start_date") < before).select(*LOAN_KEY, "loan_start_date")


@query(
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice < (SELECT quantile_disc(o_totalprice, 0.997) FROM orders)"""
)
def outlier_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return cleaning.trim_upper_tail(orders, "o_totalprice", 0.997)


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def filter_nonnegative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.nonnegative(T.table(spark, sf_dir, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


# Projections


@query(
    T.with_views("loan_daily")
    + """SELECT loan_id, Customer_ID, CAST(CASE WHEN dpd >= 60 THEN 1 ELSE 0 END AS INTEGER) AS label,
    '60dpd_6mob' AS label_def, snapshot_date FROM loan_daily WHERE mob = 6"""
)
def label_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.label_store(silver.loan_daily(T.ledger(spark, sf_dir)))


@query("SELECT * EXCLUDE (p_name, p_type) FROM part")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.drop_columns(T.table(spark, sf_dir, "part"), ["P_NAME", "p_type", "absent"])


@query("SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.select_numeric(T.table(spark, sf_dir, "lineitem"))


@query(T.with_views("clickstream") + f"SELECT {', '.join(T.CLICKSTREAM)} FROM clickstream")
def select_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.select_prefix(T.clickstream(spark, sf_dir), "fe_")


@query("SELECT o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def select_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.select_except(T.table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderdate"])


@query(
    T.with_views("raw_ledger")
    + """SELECT loan_id, Customer_ID, TRY_CAST(loan_start_date AS DATE) AS loan_start_date,
    CAST(trunc(TRY_CAST(tenure AS DOUBLE)) AS INTEGER) AS tenure,
    CAST(trunc(TRY_CAST(installment_num AS DOUBLE)) AS INTEGER) AS installment_num,
    TRY_CAST(loan_amt AS FLOAT) AS loan_amt, TRY_CAST(due_amt AS FLOAT) AS due_amt,
    TRY_CAST(paid_amt AS FLOAT) AS paid_amt, TRY_CAST(overdue_amt AS FLOAT) AS overdue_amt,
    TRY_CAST(balance AS FLOAT) AS balance, snapshot_date FROM raw_ledger"""
)
def enforce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.enforce_schema(T.raw_ledger(spark, sf_dir), LOAN_TYPES)


REJECTED = {
    "loan_start_date": "DATE", "tenure": "DOUBLE", "installment_num": "DOUBLE", "loan_amt": "FLOAT", "due_amt": "FLOAT",
    "paid_amt": "FLOAT", "overdue_amt": "FLOAT", "balance": "FLOAT",
}


@query(
    T.with_views("raw_ledger")
    + " UNION ALL ".join(
        f"""SELECT loan_id, snapshot_date, '{c}' AS "column", {c} AS text, '{LOAN_TYPES[c].simpleString()}' AS rule FROM raw_ledger
        WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL"""
        for c, t in REJECTED.items()
    )
)
def quarantined_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger typed and stored once, with the cells that no cast could read beside each row; those as a table."""
    typed = materialized(schema.enforce_with_rejects(T.raw_ledger(spark, sf_dir), LOAN_TYPES))
    return schema.quarantine(typed, ["loan_id", "snapshot_date"])


@query(T.with_views("clickstream") + "SELECT * FROM clickstream")
def typed_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.raw_clickstream(spark, sf_dir)
    return schema.enforce_schema(raw, {**CLICKSTREAM_TYPES, "fe_21": "float"}, only_present=True)


# Joins


@query(
    """SELECT c_custkey, c_mktsegment, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey"""
)
def join_inner_1key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = T.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = T.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return joins.equi_join(orders, customer, ["c_custkey"])


@query(
    T.with_views("financials", "attributes")
    + """SELECT Customer_ID, snapshot_date, f.Annual_Income, a.Occupation
    FROM financials f JOIN attributes a USING (Customer_ID, snapshot_date)"""
)
def join_inner_2key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["Customer_ID", "snapshot_date"]
    return joins.equi_join(
        T.financials(spark, sf_dir).select(*keys, "Annual_Income"),
        T.attributes(spark, sf_dir).select(*keys, "Occupation"),
        keys,
    )


# Features of the month before: most customers have none, so their rows go unmatched.
@query(
    T.with_views("ledger", "clickstream")
    + f"""SELECT l.loan_id, l.installment_num, Customer_ID, snapshot_date, {", ".join(f"c.{f}" for f in CLICKSTREAM_FEATURES)}
    FROM ledger l LEFT JOIN (SELECT * REPLACE (CAST(snapshot_date + to_months(1) AS DATE) AS snapshot_date) FROM clickstream) c
    USING (Customer_ID, snapshot_date)"""
)
def join_left_2key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["Customer_ID", "snapshot_date"]
    loans = T.ledger(spark, sf_dir).select("loan_id", "installment_num", *keys)
    return joins.lookup_join(loans, T.clickstream(spark, sf_dir, later=1), keys, "left")


@query(
    T.with_views("clickstream")
    + f"""SELECT c.*, u.c_acctbal, u.c_mktsegment, u.n_name
    FROM clickstream c JOIN (SELECT CAST(c_custkey AS STRING) AS Customer_ID, c_acctbal, c_mktsegment, n_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey) u ON c.Customer_ID = u.Customer_ID
    WHERE c.snapshot_date <= DATE '{DAY}'"""
)
def feature_store_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = T.table(spark, sf_dir, "customer"), T.table(spark, sf_dir, "nation")
    customers = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("Customer_ID"),
        F.lit("2001-12-01").cast("date").alias("snapshot_date"),
        "c_acctbal",
        "c_mktsegment",
        "n_name",
    )
    return gold.feature_store(T.clickstream(spark, sf_dir), customers, DAY)


@query(
    T.with_views("clickstream")
    + """, known AS (SELECT CAST(o_custkey AS STRING) AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS since,
    count(*) AS n_orders, max(o_totalprice) AS top_price FROM orders GROUP BY ALL),
    spans AS (SELECT *, lead(since) OVER (PARTITION BY Customer_ID ORDER BY since) AS following FROM known)
    SELECT c.*, s.n_orders, s.top_price FROM clickstream c JOIN spans s ON c.Customer_ID = s.Customer_ID
    AND c.snapshot_date >= s.since AND (s.following IS NULL OR c.snapshot_date < s.following)"""
)
def feature_store_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc("o_orderdate", "month").alias("snapshot_date")
    customers = T.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("Customer_ID"), month)
    customers = customers.agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("top_price"))
    return gold.feature_store(T.clickstream(spark, sf_dir), customers, as_of=True)


# Sorts and limits


@query("SELECT DISTINCT p_name FROM part ORDER BY p_name")
def sorted_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.distinct_values(T.table(spark, sf_dir, "part"), "p_name").sort("p_name")


@query(T.with_views("ledger") + f"SELECT {KEYS_SQL} FROM ledger ORDER BY snapshot_date, loan_id, installment_num")
def sort_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The row's other keys let the sort split a date that holds most rows.
    return T.ledger(spark, sf_dir).select(*LOAN_KEY).orderBy("snapshot_date", "loan_id", "installment_num")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


# Scalar functions

NUMBERS_SQL = ", ".join(
    f"round(TRY_CAST(regexp_replace({c}, '[^0-9\\.]', '', 'g') AS DOUBLE), 2) AS {c}"
    for c in ("Annual_Income", "Changed_Credit_Limit", "Outstanding_Debt", "Amount_invested_monthly", "Monthly_Balance")
)


@query(
    T.with_views("financials")
    + f"""SELECT Customer_ID, {NUMBERS_SQL},
    CAST(trunc(TRY_CAST(regexp_replace(Num_of_Loan, '[^0-9s\\.]', '', 'g') AS DOUBLE)) AS INTEGER) AS Num_of_Loan,
    CAST(trunc(TRY_CAST(regexp_replace(Num_of_Delayed_Payment, '[^0-9\\.]', '', 'g') AS DOUBLE)) AS INTEGER)
    AS Num_of_Delayed_Payment, CAST(Num_Credit_Inquiries AS INTEGER) AS Num_Credit_Inquiries FROM financials"""
)
def clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.financials(spark, sf_dir).select(
        "Customer_ID", "Annual_Income", "Changed_Credit_Limit", "Outstanding_Debt", "Amount_invested_monthly",
        "Monthly_Balance", "Num_of_Loan", "Num_of_Delayed_Payment", "Num_Credit_Inquiries",
    )
    return cleaning.clean_numeric(raw, silver.FINANCIAL_NUMBERS)


@query(
    T.with_views("financials")
    + """SELECT Customer_ID,
    coalesce(TRY_CAST(nullif(regexp_extract(Credit_History_Age, '([0-9]+) Years?', 1), '') AS DOUBLE), 0) * 12
    + coalesce(TRY_CAST(nullif(regexp_extract(Credit_History_Age, '([0-9]+) Months?', 1), '') AS DOUBLE), 0)
    AS months FROM financials"""
)
def parse_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.financials(spark, sf_dir).select("Customer_ID", text.parse_months(F.col("Credit_History_Age")).alias("months"))


@query(
    T.with_views("attributes")
    + """SELECT Customer_ID, CAST(CASE WHEN SSN IS NULL THEN 1
    WHEN regexp_matches(SSN, '[0-9]{3}-[0-9]{2}-[0-9]{4}') THEN 1 ELSE 0 END AS INTEGER) AS has_SSN FROM attributes"""
)
def regex_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.attributes(spark, sf_dir).select("Customer_ID", text.pattern_flag(F.col("SSN")).alias("has_SSN"))


@query("SELECT page_id, CAST(regexp_matches(url, '/[0-9]{3}') AS INTEGER) AS numbered FROM pages")
def url_pattern_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "pages").select(
        "page_id", text.pattern_flag(F.col("url"), "/[0-9]{3}").alias("numbered")
    )


SPLIT_SQL = "string_split(replace(Type_of_Loan, ' and ', ', '), ',')"


def _loan_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.split(F.regexp_replace("Type_of_Loan", " and ", ", "), ",")
    return T.financials(spark, sf_dir).select("Customer_ID", listed.alias("items"))


@query(
    T.with_views("financials")
    + f"""SELECT Customer_ID, array_to_string([trim(x) FOR x IN {SPLIT_SQL}], '|') AS items FROM financials"""
)
def array_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _loan_lists(spark, sf_dir)
    return rows.select("Customer_ID", F.array_join(arrays.trim_each(F.col("items")), "|").alias("items"))


@query(
    T.with_views("financials")
    + f"""SELECT Customer_ID, array_to_string([x FOR x IN {SPLIT_SQL} IF x <> ''], '|') AS items,
    CAST(len([x FOR x IN {SPLIT_SQL} IF x <> '']) AS INTEGER) AS n FROM financials"""
)
def array_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = arrays.drop_blank(F.col("items"))
    return _loan_lists(spark, sf_dir).select(
        "Customer_ID", F.array_join(kept, "|").alias("items"), F.size(kept).alias("n")
    )


LOAN_LIST_SQL = (
    f"CASE WHEN Type_of_Loan IS NULL OR len([x FOR x IN {SPLIT_SQL} IF trim(x) <> '']) = 0 THEN ['No loan']"
    f" ELSE [trim(x) FOR x IN {SPLIT_SQL} IF trim(x) <> ''] END"
)


@query(
    T.with_views("financials")
    + f"SELECT Customer_ID, array_to_string({LOAN_LIST_SQL}, '|') AS items FROM financials"
)
def array_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = arrays.split_list(F.col("Type_of_Loan"))
    return T.financials(spark, sf_dir).select("Customer_ID", F.array_join(listed, "|").alias("items"))


@query(
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) - to_months(l_linenumber) AS DATE) AS earlier,
    CAST(last_day(l_shipdate) - to_months(l_linenumber) AS DATE) AS earlier_end FROM lineitem"""
)
def add_months_neg(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = -F.col("l_linenumber")
    return T.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.add_months(F.col("l_shipdate").cast("date"), back).alias("earlier"),
        F.add_months(F.last_day("l_shipdate"), back).alias("earlier_end"),
    )


@query(
    """SELECT o_orderkey, round(o_totalprice / 13.0, 2) AS monthly, CAST(o_orderkey % 100 AS INTEGER) AS part
    FROM orders"""
)
def round_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    money = T.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") / 13.0).alias("monthly"),
        (F.col("o_orderkey") % 100).cast("int").alias("part"),
    )
    return cleaning.round_columns(money, ["monthly", "part"])


@query(
    """SELECT o_orderkey, CAST(CASE WHEN o_orderpriority LIKE '%HIGH%' THEN 1 WHEN o_orderpriority LIKE '%LOW%' THEN 0
    ELSE -1 END AS INTEGER) AS level, CAST(CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END AS INTEGER) AS big
    FROM orders"""
)
def case_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.first_keyword(F.col("o_orderpriority"), {"HIGH": 1, "LOW": 0}, -1).alias("level"),
        at_least_flag(F.col("o_totalprice"), 250000).alias("big"),
    )


@query(
    T.with_views("ledger")
    + """SELECT loan_id, installment_num, coalesce(due_amt, 0) AS due_amt, coalesce(overdue_amt, 0) AS overdue_amt,
    snapshot_date FROM ledger"""
)
def fill_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.ledger(spark, sf_dir).select("loan_id", "installment_num", "due_amt", "overdue_amt", "snapshot_date")
    return cleaning.fill_zero(rows)
