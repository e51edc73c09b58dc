"""Loan-shaped views of the TPC-H-like test tables.

Each view is a projection of given tables, written in SQL expressions both engines understand, so
that the query and its check start from the same input. Divisions by values that may be 0, NULLs,
blank and unreadable text are put in on purpose.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditmart.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


LOAN_ROWS = "lineitem JOIN orders ON l_orderkey = o_orderkey"
SNAPSHOT = "CAST(date_trunc('month', l_shipdate) AS DATE)"

LEDGER = {
    "loan_id": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING))",
    "Customer_ID": "CAST(o_custkey AS STRING)",
    "loan_start_date": "CAST(o_orderdate AS DATE)",
    "tenure": "CAST(7 AS INT)",
    "installment_num": "l_linenumber",
    "loan_amt": "CAST(o_totalprice AS FLOAT)",
    "due_amt": "CAST(CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN 0.0"
    " ELSE l_extendedprice / l_quantity END AS FLOAT)",
    "paid_amt": "CAST(l_extendedprice * (1 - l_discount) AS FLOAT)",
    "overdue_amt": "CAST(CASE WHEN l_suppkey % 83 = 0 THEN NULL WHEN l_returnflag = 'R'"
    " THEN l_extendedprice * l_discount ELSE 0.0 END AS FLOAT)",
    "balance": "CAST(l_extendedprice * (1 + l_tax) AS FLOAT)",
    "snapshot_date": SNAPSHOT,
}

RAW_LEDGER = {
    "loan_id": LEDGER["loan_id"],
    "Customer_ID": LEDGER["Customer_ID"],
    "loan_start_date": "CASE WHEN l_partkey % 101 = 0 THEN 'unknown'"
    " ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "tenure": "CASE WHEN l_partkey % 7 = 0 THEN '7.9' ELSE '7' END",
    "installment_num": "CASE WHEN l_partkey % 103 = 0 THEN '' ELSE CAST(l_linenumber AS STRING) END",
    "loan_amt": "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)",
    "due_amt": "CASE WHEN l_partkey % 97 = 0 THEN 'n/a' WHEN l_partkey % 89 = 0 THEN '0'"
    " ELSE concat(CAST(CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS STRING), '.25') END",
    "paid_amt": "CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING)",
    "overdue_amt": "CASE WHEN l_suppkey % 83 = 0 THEN NULL WHEN l_returnflag = 'R'"
    " THEN CAST(CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS STRING) ELSE '0' END",
    "balance": "concat(CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING), '.5')",
    "snapshot_date": SNAPSHOT,
}

# Twenty exact (order-independent) measures of a customer's month.
CLICKSTREAM = {
    "fe_1": "count(*)",
    "fe_2": "sum(l_quantity)",
    "fe_3": "max(l_discount)",
    "fe_4": "min(l_discount)",
    "fe_5": "max(l_quantity)",
    "fe_6": "min(l_quantity)",
    "fe_7": "max(l_extendedprice)",
    "fe_8": "min(l_extendedprice)",
    "fe_9": "max(l_tax)",
    "fe_10": "min(l_tax)",
    "fe_11": "sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)",
    "fe_12": "sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)",
    "fe_13": "sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)",
    "fe_14": "max(l_linenumber)",
    "fe_15": "sum(l_linenumber)",
    "fe_16": "max(l_partkey % 100)",
    "fe_17": "min(l_partkey % 100)",
    "fe_18": "sum(l_suppkey % 10)",
    "fe_19": "max(CASE WHEN l_returnflag = 'R' THEN l_quantity * l_discount ELSE 0.0 END)",
    "fe_20": "sum(l_partkey % 10)",
}

KINDS_OF_LOAN = (
    "Auto Loan", "Credit-Builder Loan", "Debt Consolidation Loan", "Home Equity Loan", "Mortgage Loan",
    "Not Specified", "Payday Loan", "Personal Loan", "Student Loan",
)
OCCUPATIONS = ("Architect", "Doctor", "Engineer", "Lawyer", "Media_Manager", "Teacher", "Writer")
CREDIT_MIXES = ("Bad", "Good", "Standard", "_")
BEHAVIOURS = (
    "High_spent_Small_value_payments", "High_spent_Medium_value_payments", "High_spent_Large_value_payments",
    "Low_spent_Small_value_payments", "Low_spent_Medium_value_payments", "Low_spent_Large_value_payments", "!@9#%8",
)


def pick(index: str, values: tuple[str, ...]) -> str:
    """SQL for the value at index modulo their number."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({index}) % {len(values)} {cases} END"


def whole(expr: str) -> str:
    return f"CAST(floor({expr}) AS BIGINT)"


MONEY = "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING)"

FINANCIALS = {
    "Customer_ID": "CAST(o_orderkey AS STRING)",
    "Annual_Income": f"CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 5 = 0"
    f" THEN concat({MONEY}, '_') ELSE {MONEY} END",
    "Monthly_Inhand_Salary": "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_totalprice / 13.0 END",
    "Num_Bank_Accounts": "CAST(o_orderkey % 13 - 1 AS INT)",
    "Num_Credit_Card": "CAST(CASE WHEN o_orderkey % 47 = 0 THEN 1499 ELSE o_custkey % 11 END AS INT)",
    "Interest_Rate": "CAST(CASE WHEN o_orderkey % 53 = 0 THEN 5789 WHEN o_orderkey % 59 = 0 THEN NULL"
    " ELSE (o_orderkey * 7) % 34 END AS DOUBLE)",
    "Num_of_Loan": "CASE WHEN o_orderkey % 37 = 0 THEN '3s' WHEN o_orderkey % 41 = 0 THEN '-100' WHEN o_orderkey % 7 = 0"
    " THEN concat(CAST(o_orderkey % 9 AS STRING), '_') ELSE CAST(o_orderkey % 9 AS STRING) END",
    "Type_of_Loan": f"CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN ''"
    f" WHEN o_orderkey % 3 = 0 THEN {pick('o_orderkey', KINDS_OF_LOAN)}"
    f" ELSE concat({pick('o_orderkey', KINDS_OF_LOAN)}, ', ', {pick('o_custkey', KINDS_OF_LOAN)},"
    f" ', and ', {pick('o_orderkey + o_custkey', KINDS_OF_LOAN)}) END",
    "Delay_from_due_date": "CAST(o_orderkey % 60 AS INT)",
    "Num_of_Delayed_Payment": "CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN '4292_'"
    " ELSE CAST(o_custkey % 28 AS STRING) END",
    "Changed_Credit_Limit": "CASE WHEN o_orderkey % 20 = 0 THEN '_'"
    " ELSE concat(CASE WHEN o_orderkey % 4 = 0 THEN '-' ELSE '' END, CAST(o_custkey % 30 AS STRING), '.',"
    " CAST(o_orderkey % 10 AS STRING), '7') END",
    "Num_Credit_Inquiries": "CAST(CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 67 = 0 THEN 2594"
    " ELSE o_custkey % 17 END AS DOUBLE)",
    "Credit_Mix": pick("o_orderkey", CREDIT_MIXES),
    "Outstanding_Debt": f"CASE WHEN o_orderkey % 11 = 0 THEN concat({MONEY}, '_') ELSE {MONEY} END",
    "Credit_Utilization_Ratio": "o_totalprice / 7000.0",
    "Credit_History_Age": "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 71 = 0 THEN 'NA'"
    f" ELSE concat(CAST({whole('o_custkey % 400 / 12')} AS STRING), ' Years and ',"
    " CAST(o_custkey % 400 % 12 AS STRING), ' Months') END",
    "Payment_of_Min_Amount": pick("o_custkey", ("NM", "No", "Yes")),
    "Total_EMI_per_month": "o_totalprice / 1300.0",
    "Amount_invested_monthly": f"CASE WHEN o_orderkey % 73 = 0 THEN '__10000__' ELSE {MONEY} END",
    "Payment_Behaviour": pick("o_orderkey", BEHAVIOURS),
    "Monthly_Balance": f"CASE WHEN o_orderkey % 79 = 0 THEN '__' ELSE {MONEY} END",
    "snapshot_date": "CAST(date_trunc('month', o_orderdate) AS DATE)",
}

ATTRIBUTES = {
    "Customer_ID": "CAST(o_orderkey AS STRING)",
    "Name": "concat('Customer ', CAST(o_custkey AS STRING))",
    "Age": "CASE WHEN o_orderkey % 17 = 0 THEN '-500' WHEN o_orderkey % 19 = 0 THEN NULL"
    " WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 5 = 0 THEN concat(CAST(18 + o_custkey % 40 AS STRING), '_')"
    " ELSE CAST(18 + o_custkey % 40 AS STRING) END",
    "SSN": "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '#F%$D@*&8'"
    " ELSE concat(lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'), '-', lpad(CAST(o_custkey % 100 AS STRING), 2, '0'),"
    " '-', lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0')) END",
    "Occupation": f"CASE WHEN o_orderkey % 14 = 0 THEN '_______' ELSE {pick('o_custkey', OCCUPATIONS)} END",
    "snapshot_date": "CAST(date_trunc('month', o_orderdate) AS DATE)",
}

# A made-up score of each ledger row that is related to its label, with ties.
SCORED = {
    "label": "CAST(CASE WHEN l_returnflag = 'R' AND l_quantity * l_discount > 1.0 THEN 1 ELSE 0 END AS INT)",
    "score": "CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN CAST('NaN' AS DOUBLE)"
    " ELSE (l_quantity * l_discount + CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END"
    " + (l_partkey % 50) / 50.0) / 7.0 END",
}


def _items(view: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in view.items()]


def select_sql(view: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(_items(view))} FROM {source}"


def loan_rows(spark: SparkSession, sf_dir: str, **narrowed: str) -> DataFrame:
    """Lines with their order. A line meets it dated by month, and with the ``narrowed`` columns: what the views need of it
    takes less to shuffle."""
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    lines = lineitem.withColumns({c: F.expr(e) for c, e in {"l_shipdate": SNAPSHOT, **narrowed}.items()})
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def ledger(spark: SparkSession, sf_dir: str, gather: bool = False) -> DataFrame:
    """``gather`` brings the rows of a month together, as a write split by month needs them, before their texts are made."""
    rows = loan_rows(spark, sf_dir)
    return (rows.hint("rebalance", "l_shipdate") if gather else rows).selectExpr(*_items(LEDGER))


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_rows(spark, sf_dir).selectExpr(*_items(RAW_LEDGER))


def raw_clickstream(spark: SparkSession, sf_dir: str, later: int = 0) -> DataFrame:
    """One row per customer and month; a few values are unreadable text. Rows are dated ``later`` months after theirs: done
    before the aggregation, its shuffle serves a join on the later dates too."""
    month = f"add_months({SNAPSHOT}, {later})" if later else SNAPSHOT
    lines = loan_rows(spark, sf_dir, l_partkey="l_partkey % 100", l_suppkey="l_suppkey % 10")  # all the measures use of them
    keys = lines.selectExpr("*", f"{LEDGER['Customer_ID']} AS Customer_ID", f"{month} AS snapshot_date")
    return keys.groupBy("Customer_ID", "snapshot_date").agg(*[F.expr(e).alias(n) for n, e in CLICKSTREAM.items()])


def clickstream(spark: SparkSession, sf_dir: str, later: int = 0) -> DataFrame:
    return raw_clickstream(spark, sf_dir, later).selectExpr(
        "Customer_ID", "snapshot_date", *[f"CAST({n} AS FLOAT) AS {n}" for n in CLICKSTREAM]
    )


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_items(FINANCIALS))


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_items(ATTRIBUTES))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_items(SCORED))


_CLICK_KEYS = f"{LEDGER['Customer_ID']} AS Customer_ID, {SNAPSHOT} AS snapshot_date"
VIEWS = {
    "ledger": select_sql(LEDGER, LOAN_ROWS),
    "raw_ledger": select_sql(RAW_LEDGER, LOAN_ROWS),
    "clickstream": f"SELECT {_CLICK_KEYS}, "
    + ", ".join(f"CAST({e} AS FLOAT) AS {n}" for n, e in CLICKSTREAM.items())
    + f" FROM {LOAN_ROWS} GROUP BY 1, 2",
    "financials": select_sql(FINANCIALS, "orders"),
    "attributes": select_sql(ATTRIBUTES, "orders"),
    "scored": select_sql(SCORED, "lineitem"),
}

# Days past due, written independently of the Spark code.
VIEWS["missed"] = (
    "SELECT * REPLACE (coalesce(tenure, 0) AS tenure, coalesce(installment_num, 0) AS installment_num,"
    " coalesce(loan_amt, 0) AS loan_amt, coalesce(due_amt, 0) AS due_amt, coalesce(paid_amt, 0) AS paid_amt,"
    " coalesce(overdue_amt, 0) AS overdue_amt, coalesce(balance, 0) AS balance),"
    " coalesce(installment_num, 0) AS mob,"
    " CAST(coalesce(ceil(CAST(overdue_amt AS DOUBLE) / nullif(CAST(due_amt AS DOUBLE), 0)), 0) AS INTEGER)"
    " AS installments_missed FROM ledger"
)
VIEWS["dated"] = (
    "SELECT *, CASE WHEN installments_missed > 0"
    " THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date FROM missed"
)
VIEWS["loan_daily"] = (
    "SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date)"
    " ELSE 0 END AS INTEGER) AS dpd FROM dated"
)
_NEEDS = {"missed": ["ledger"], "dated": ["missed"], "loan_daily": ["dated"]}


def with_views(*names: str) -> str:
    """``WITH`` clause that defines the named views and those they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{name} AS ({VIEWS[name]})" for name in ordered) + " "


def scratch_root(spark: SparkSession) -> str:
    """A new folder in the cluster's shared folder, for tables a query writes and reads back."""
    return f"{shared_folder(spark)}/creditmart-{uuid.uuid4().hex}"
