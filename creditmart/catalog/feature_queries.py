"""Feature operators of the credit domain and the silver and gold tables made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditmart.catalog import tables as T
from creditmart.catalog.registry import query
from creditmart.catalog.row_queries import LOAN_LIST_SQL
from creditmart.functions import text
from creditmart.operators import cleaning, encoding, labels
from creditmart.plans import fitted, gold, silver
from creditmart.session import materialized
from creditmart.sources.datamart import Datamart

# Categories in the views of the test tables.
MIXES = ("Bad", "Good", "Invalid", "Standard")
MIN_PAYMENTS = ("NM", "No", "Yes")
JOBS = (*T.OCCUPATIONS, "Others")


def flags_sql(column: str, prefix: str, values: tuple[str, ...]) -> str:
    return ", ".join(
        f"CAST(CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS INTEGER) AS {encoding.flag_name(prefix, v)}"
        for v in values
    )


def list_flags_sql(expr: str, prefix: str, values: tuple[str, ...]) -> str:
    return ", ".join(
        f"CAST(list_contains({expr}, '{v}') AS INTEGER) AS {encoding.flag_name(prefix, v)}" for v in values
    )


# Loan performance


@query(
    T.with_views("loan_daily")
    + """SELECT loan_id, installment_num, installments_missed, first_missed_date, dpd, snapshot_date FROM loan_daily"""
)
def dpd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.add_delinquency(T.ledger(spark, sf_dir)).select(
        "loan_id", "installment_num", "installments_missed", "first_missed_date", "dpd", "snapshot_date"
    )


@query(T.with_views("loan_daily") + "SELECT * FROM loan_daily")
def loan_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.loan_daily(T.ledger(spark, sf_dir))


@query(
    T.with_views("loan_daily")
    + """SELECT loan_id, Customer_ID, CAST(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS INTEGER) AS label,
    '30dpd_6mob' AS label_def, snapshot_date FROM loan_daily WHERE mob = 6"""
)
def label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.label_store(silver.loan_daily(T.ledger(spark, sf_dir)), dpd=30, mob=6)


@query(
    T.with_views("loan_daily")
    + """SELECT mob, count(*) AS n, CAST(sum(CASE WHEN dpd >= 60 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad,
    avg(CASE WHEN dpd >= 60 THEN 1 ELSE 0 END) AS bad_rate FROM loan_daily
    WHERE loan_start_date < DATE '2000-01-01' GROUP BY mob ORDER BY mob"""
)
def bad_rate_by_mob(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.bad_rate_curve(silver.loan_daily(T.ledger(spark, sf_dir)), 60, "2000-01-01")


# Cleaning and capping


@query(
    """WITH caps AS (SELECT quantile_disc(l_extendedprice, 0.95) AS price, quantile_disc(l_quantity, 0.95) AS quantity,
    quantile_disc(l_linenumber, 0.95) AS line FROM lineitem)
    SELECT l_orderkey, CASE WHEN l_extendedprice > price THEN price ELSE l_extendedprice END AS l_extendedprice,
    CASE WHEN l_quantity > quantity THEN quantity ELSE l_quantity END AS l_quantity,
    CASE WHEN l_linenumber > line THEN line ELSE l_linenumber END AS l_linenumber FROM lineitem, caps"""
)
def winsorize_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity", "l_linenumber")
    return cleaning.winsorize_upper(rows, {"l_extendedprice": 0.95, "l_quantity": 0.95, "l_linenumber": 0.95})


AGE_SQL = "CAST(trunc(TRY_CAST(regexp_replace(Age, '[^0-9]', '', 'g') AS DOUBLE)) AS INTEGER)"


@query(
    T.with_views("attributes")
    + f""", ages AS (SELECT Customer_ID, {AGE_SQL} AS age FROM attributes),
    middle AS (SELECT quantile_disc(age, 0.5) AS m FROM ages)
    SELECT Customer_ID, CAST(CASE WHEN age > 100 OR age IS NULL THEN m ELSE age END AS DOUBLE) AS Age
    FROM ages, middle"""
)
def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.impute_median(T.attributes(spark, sf_dir).select("Customer_ID", "Age"), "Age")


# Recoding and encoding


@query(
    T.with_views("attributes")
    + """SELECT Customer_ID, CASE WHEN regexp_matches(Occupation, '[a-zA-Z]') THEN Occupation ELSE 'Others' END
    AS Occupation FROM attributes"""
)
def recode_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = text.recode_unmatched(F.col("Occupation"), text.HAS_LETTER, "Others")
    return T.attributes(spark, sf_dir).select("Customer_ID", job.alias("Occupation"))


SPENDING_SQL = """CAST(CASE WHEN contains(Payment_Behaviour, 'High') THEN 1
    WHEN contains(Payment_Behaviour, 'Low') THEN 0 ELSE -1 END AS INTEGER)"""
SIZE_SQL = """CAST(CASE WHEN contains(Payment_Behaviour, 'Small') THEN 1 WHEN contains(Payment_Behaviour, 'Medium')
    THEN 2 WHEN contains(Payment_Behaviour, 'Large') THEN 3 ELSE 0 END AS INTEGER)"""


@query(T.with_views("financials") + f"SELECT Customer_ID, {SPENDING_SQL} AS Spending_Level FROM financials")
def spending_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = text.spending_level(F.col("Payment_Behaviour"))
    return T.financials(spark, sf_dir).select("Customer_ID", level.alias("Spending_Level"))


@query(T.with_views("financials") + f"SELECT Customer_ID, {SIZE_SQL} AS Payment_Size FROM financials")
def payment_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = text.payment_size(F.col("Payment_Behaviour"))
    return T.financials(spark, sf_dir).select("Customer_ID", size.alias("Payment_Size"))


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(f"SELECT c_custkey, c_mktsegment, {flags_sql('c_mktsegment', 'c_mktsegment', SEGMENTS)} FROM customer")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.one_hot(T.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query(
    T.with_views("financials")
    + f"SELECT Customer_ID, Type_of_Loan, {list_flags_sql(LOAN_LIST_SQL, 'loan_type', T.KINDS_OF_LOAN)} FROM financials"
)
def multi_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.multi_hot(
        T.financials(spark, sf_dir).select("Customer_ID", "Type_of_Loan"), "Type_of_Loan", "loan_type"
    )


# Whole tables


def _number(c: str) -> str:
    return f"round(TRY_CAST(regexp_replace({c}, '[^0-9\\.]', '', 'g') AS DOUBLE), 2)"


def half_up(c: str) -> str:
    """Rounding of the decimal value, as Spark does: 19.275 to 19.28, whatever its binary form is."""
    return f"CAST(round(CAST({c} AS DECIMAL(30, 12)), 2) AS DOUBLE)"


CAPS = {
    "Num_Bank_Accounts": "INTEGER",
    "Num_Credit_Card": "INTEGER",
    "Num_of_Loan": "INTEGER",
    "Num_of_Delayed_Payment": "INTEGER",
    "Num_Credit_Inquiries": "INTEGER",
    "Interest_Rate": "DOUBLE",
}
FINANCIAL_STEPS_SQL = f""", read AS (SELECT * REPLACE (
    {_number('Annual_Income')} AS Annual_Income, {_number('Changed_Credit_Limit')} AS Changed_Credit_Limit,
    {_number('Outstanding_Debt')} AS Outstanding_Debt, {_number('Amount_invested_monthly')} AS Amount_invested_monthly,
    {_number('Monthly_Balance')} AS Monthly_Balance,
    CAST(trunc(TRY_CAST(regexp_replace(Num_of_Loan, '[^0-9s\\.]', '', 'g') AS DOUBLE)) AS INTEGER) AS Num_of_Loan,
    CAST(trunc({_number('Num_of_Delayed_Payment')}) AS INTEGER) AS Num_of_Delayed_Payment,
    CAST(Num_Credit_Inquiries AS INTEGER) AS Num_Credit_Inquiries,
    {half_up('Credit_Utilization_Ratio')} AS Credit_Utilization_Ratio,
    {half_up('Total_EMI_per_month')} AS Total_EMI_per_month),
    coalesce(TRY_CAST(nullif(regexp_extract(Credit_History_Age, '([0-9]+) Years?', 1), '') AS DOUBLE), 0) * 12
    + coalesce(TRY_CAST(nullif(regexp_extract(Credit_History_Age, '([0-9]+) Months?', 1), '') AS DOUBLE), 0)
    AS Credit_History_Age_Months FROM financials),
    kept AS (SELECT * REPLACE (coalesce(Changed_Credit_Limit, 0) AS Changed_Credit_Limit) FROM read
    WHERE Monthly_Balance < (SELECT quantile_disc(Monthly_Balance, 0.997) FROM read) AND Num_Bank_Accounts >= 0),
    caps AS (SELECT {', '.join(f'quantile_disc({c}, 0.95) AS cap_{c}' for c in CAPS)} FROM kept),
    capped AS (SELECT kept.* REPLACE ({', '.join(
        f'CAST(CASE WHEN {c} > cap_{c} THEN cap_{c} ELSE {c} END AS {t}) AS {c}' for c, t in CAPS.items())},
    CASE WHEN Credit_Mix = '_' THEN 'Invalid' ELSE Credit_Mix END AS Credit_Mix) FROM kept, caps),
    money AS (SELECT Customer_ID, snapshot_date, Annual_Income, Changed_Credit_Limit, Outstanding_Debt,
    Amount_invested_monthly, Monthly_Balance, {', '.join(CAPS)}, Delay_from_due_date, Credit_Utilization_Ratio,
    Total_EMI_per_month, Credit_History_Age_Months, {SPENDING_SQL} AS Spending_Level, {SIZE_SQL} AS Payment_Size,
    {list_flags_sql(LOAN_LIST_SQL, 'loan_type', T.KINDS_OF_LOAN)}, {flags_sql('Credit_Mix', 'credit_mix', MIXES)},
    {flags_sql('Payment_of_Min_Amount', 'payment_of_min_amount', ('NM', 'Yes'))} FROM capped)"""
ATTRIBUTE_STEPS_SQL = f""", person AS (SELECT Customer_ID, snapshot_date, {AGE_SQL} AS age,
    CAST(CASE WHEN SSN IS NULL OR regexp_matches(SSN, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}') THEN 1 ELSE 0 END AS INTEGER)
    AS has_SSN, CASE WHEN regexp_matches(Occupation, '[a-zA-Z]') THEN Occupation ELSE 'Others' END AS job
    FROM attributes),
    people AS (SELECT Customer_ID, snapshot_date, has_SSN, {flags_sql('job', 'occupation', JOBS)},
    CAST(CASE WHEN age > 100 OR age IS NULL THEN (SELECT quantile_disc(age, 0.5) FROM person) ELSE age END AS DOUBLE)
    AS Age FROM person)"""


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed financials as a stored table, like the job has them: later passes read typed columns."""
    path = f"{T.scratch_root(spark)}/financial_numbers"
    silver.financial_numbers(T.financials(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@query(
    T.with_views("financials", "attributes")
    + FINANCIAL_STEPS_SQL
    + ATTRIBUTE_STEPS_SQL
    + "SELECT * FROM money JOIN people USING (Customer_ID, snapshot_date)"
)
def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.customer_features(_numbers(spark, sf_dir), T.attributes(spark, sf_dir), parsed=True)


@query(T.with_views("attributes") + ATTRIBUTE_STEPS_SQL + "SELECT * FROM people")
def customer_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.attributes(T.attributes(spark, sf_dir))


def _year(y: int) -> str:
    return f"snapshot_date BETWEEN DATE '{y}-01-01' AND DATE '{y}-12-31'"


FITTED_SQL = (
    (FINANCIAL_STEPS_SQL + ATTRIBUTE_STEPS_SQL)
    .replace("0.997) FROM read)", f"0.997) FROM read WHERE {_year(1997)})")
    .replace("FROM kept),\n    capped", f"FROM kept WHERE {_year(1997)}),\n    capped")
    .replace("quantile_disc(age, 0.5) FROM person)", f"quantile_disc(age, 0.5) FROM person WHERE {_year(1997)})")
)


@query(
    T.with_views("financials", "attributes")
    + FITTED_SQL
    + f"SELECT * FROM money JOIN people USING (Customer_ID, snapshot_date) WHERE {_year(1998)}"
)
def apply_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caps, median and vocabularies of 1997, stored as a version and read back, applied to the customers of 1998."""
    mart = Datamart(spark, T.scratch_root(spark))
    numbers, people = _numbers(spark, sf_dir), T.attributes(spark, sf_dir)
    fitted.save(mart, silver.fit_customers(numbers.where(_year(1997)), people.where(_year(1997))), "1997-12-01")
    state = fitted.load(mart)
    return silver.customer_features(numbers.where(_year(1998)), people.where(_year(1998)), parsed=True, fitted=state)


@query(
    T.with_views("financials", "attributes")
    + f""", cells AS (SELECT 'Credit_Mix' AS "column", CASE WHEN Credit_Mix = '_' THEN 'Invalid' ELSE Credit_Mix END AS value, snapshot_date FROM financials
    UNION ALL SELECT 'Payment_of_Min_Amount', Payment_of_Min_Amount, snapshot_date FROM financials
    UNION ALL SELECT 'Occupation', CASE WHEN regexp_matches(Occupation, '[a-zA-Z]') THEN Occupation ELSE 'Others' END, snapshot_date FROM attributes
    UNION ALL SELECT 'Type_of_Loan', unnest(list_distinct({LOAN_LIST_SQL})), snapshot_date FROM financials)
    SELECT "column", value, count(*) AS n_rows FROM cells WHERE {_year(1998)} AND value NOT IN ('No loan', 'Bad', 'Yes', 'Doctor', 'Lawyer', 'Auto Loan')
    GROUP BY ALL"""
)
def unseen_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of 1998 that a state with few known ones has not seen."""
    vocab = silver.Vocabularies(["Auto Loan"], ["Bad"], ["Yes"], ["Doctor", "Lawyer"])
    state = silver.Fitted(None, {}, None, vocab)
    return silver.unseen_categories(T.financials(spark, sf_dir).where(_year(1998)), T.attributes(spark, sf_dir).where(_year(1998)), state)


@query(
    T.with_views("financials", "clickstream")
    + FINANCIAL_STEPS_SQL
    + """SELECT c.*, m.* EXCLUDE (Customer_ID, snapshot_date) FROM clickstream c
    JOIN money m ON c.Customer_ID = m.Customer_ID"""
)
def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = silver.Vocabularies(T.KINDS_OF_LOAN, MIXES, MIN_PAYMENTS)
    customers = silver.customer_features(_numbers(spark, sf_dir), None, vocab, parsed=True)
    return gold.feature_store(T.clickstream(spark, sf_dir), materialized(customers))


@query(
    """WITH listed AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS buyer, o_orderpriority, [o_orderstatus, o_orderpriority, o_orderstatus] AS marks FROM orders),
    cells AS (SELECT o_orderkey, 'buyer' AS c, buyer AS v FROM listed UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM listed
    UNION ALL SELECT DISTINCT o_orderkey, 'marks', unnest(marks) FROM listed),
    vocab AS (SELECT c, v, row_number() OVER (ORDER BY c, md5(v), v) - 1 AS place FROM (SELECT DISTINCT c, v FROM cells))
    SELECT o_orderkey, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS size, array_to_string(list_sort(list(CAST(place AS INTEGER))), ',') AS indices,
    CAST(sum(1) AS DOUBLE) AS total FROM cells JOIN vocab USING (c, v) GROUP BY o_orderkey"""
)
def sparse_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers (a category for every few orders), priorities and a list of marks as one sparse vector an order."""
    marks = F.array("o_orderstatus", "o_orderpriority", "o_orderstatus").alias("marks")
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("buyer"), "o_orderpriority", marks)
    names = ["buyer", "o_orderpriority", "marks"]
    found = encoding.sparse_features(orders, "o_orderkey", names, encoding.vocabulary_table(orders, names))
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return found.select("o_orderkey", "size", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"), total.alias("total"))
