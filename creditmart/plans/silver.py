"""Silver tables from bronze frames: typed, cleaned, derived and encoded."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from creditmart.functions.arrays import split_list
from creditmart.functions.casting import as_double, as_int
from creditmart.functions.text import (
    DIGITS_S_AND_DOT, HAS_LETTER, parse_months, pattern_flag, payment_size, recode, recode_unmatched,
    spending_level,
)
from creditmart.operators import cleaning, encoding
from creditmart.operators.cleaning import NumberRule
from creditmart.operators.joins import equi_join
from creditmart.operators.labels import add_delinquency
from creditmart.operators.schema import drop_columns, enforce_schema
from creditmart.session import materialized
from creditmart.sources.schemas import CLICKSTREAM_TYPES, LOAN_TYPES

# How the dirty financial numbers are read.
FINANCIAL_NUMBERS = {
    "Annual_Income": NumberRule(),
    "Num_of_Loan": NumberRule(DIGITS_S_AND_DOT, integer=True),
    "Num_of_Delayed_Payment": NumberRule(integer=True),
    "Changed_Credit_Limit": NumberRule(),
    "Outstanding_Debt": NumberRule(),
    "Amount_invested_monthly": NumberRule(),
    "Monthly_Balance": NumberRule(),
    "Num_Credit_Inquiries": NumberRule(integer=True),
    "Monthly_Inhand_Salary": NumberRule(),
    "Credit_Utilization_Ratio": NumberRule(),
    "Total_EMI_per_month": NumberRule(),
}

# Financial numbers that are read as they stand.
FINANCIAL_PLAIN = {
    "Num_Bank_Accounts": as_int,
    "Num_Credit_Card": as_int,
    "Interest_Rate": as_double,
    "Delay_from_due_date": as_int,
}

# Columns capped at their 95th percentile.
CAPPED_COUNTS = (
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_of_Loan",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
)
CAPPED_RATE = "Interest_Rate"

# Columns that encoding has used up, and the reference category of a flag group.
FINANCIAL_LEFTOVERS = (
    "Monthly_Inhand_Salary",
    "Type_of_Loan",
    "Payment_Behaviour",
    "Payment_of_Min_Amount",
    "payment_of_min_amount_no",
    "Credit_Mix",
)
ATTRIBUTE_LEFTOVERS = ("Occupation", "SSN", "Name")
#: What an empty list of loans counts as; it has no flag.
NO_LOAN = "No loan"


@dataclass(frozen=True)
class Vocabularies:
    """Categories to encode; None reads them from the data."""

    loan_types: Sequence[str] | None = None
    credit_mix: Sequence[str] | None = None
    min_payment: Sequence[str] | None = None
    occupations: Sequence[str] | None = None

    def completed(self, financials: DataFrame) -> Vocabularies:
        """The financial vocabularies that are not given read from the data, in one pass."""
        columns = {
            "loan_types": split_list(F.col("Type_of_Loan")),
            "credit_mix": F.col("Credit_Mix"),
            "min_payment": F.col("Payment_of_Min_Amount"),
        }
        unknown = {name: c for name, c in columns.items() if getattr(self, name) is None}
        if not unknown:
            return self
        read = financials.select(*[c.alias(name) for name, c in unknown.items()])
        return replace(self, **encoding.vocabularies(read, list(unknown)))


@dataclass(frozen=True)
class Fitted:
    """What the customer features learn from data: applied to later snapshots, it gives them the same columns and caps."""

    balance_cut: float | None
    caps: dict[str, float | int | None]
    age_median: float | None
    vocab: Vocabularies


def loan_daily(bronze: DataFrame) -> DataFrame:
    """Typed loan ledger with months on book and days past due."""
    typed = enforce_schema(bronze, LOAN_TYPES)
    return add_delinquency(typed.withColumn("mob", F.col("installment_num")))


def clickstream(bronze: DataFrame) -> DataFrame:
    return enforce_schema(bronze, CLICKSTREAM_TYPES, only_present=True)


def financial_numbers(bronze: DataFrame) -> DataFrame:
    """Dirty numbers read, and the credit history turned into months."""
    numbers = set(dict(bronze.dtypes)) & set(FINANCIAL_PLAIN)
    kept = {c: F.regexp_replace(F.col(c), "_", "") if dict(bronze.dtypes)[c] == "string" else F.col(c) for c in numbers}
    typed = bronze.withColumns({c: FINANCIAL_PLAIN[c](v) for c, v in kept.items()})
    read = cleaning.clean_numeric(typed, FINANCIAL_NUMBERS)
    return read.withColumn("Credit_History_Age_Months", parse_months(F.col("Credit_History_Age"))).drop(
        "Credit_History_Age"
    )


def financial_outliers(df: DataFrame, rel_err: float = 0.0, fitted: Fitted | None = None) -> DataFrame:
    """Extreme balances and impossible account counts removed, the upper tails capped.

    The caps are those of the rows that remain, or the fitted ones.
    """
    if fitted is None:
        cut, caps = _fit_outliers(df, rel_err)
    else:
        cut, caps = fitted.balance_cut, fitted.caps
    capped = cleaning.apply_caps(_plausible(df, cut), caps)
    return capped.withColumn(CAPPED_RATE, F.round(CAPPED_RATE, 2))


def _plausible(df: DataFrame, cut: float | None) -> DataFrame:
    kept = cleaning.nonnegative(cleaning.below(df, "Monthly_Balance", cut), "Num_Bank_Accounts")
    return kept.withColumn("Changed_Credit_Limit", F.coalesce("Changed_Credit_Limit", F.lit(0.0)))


def _fit_outliers(df: DataFrame, rel_err: float = 0.0) -> tuple[float | None, dict]:
    cut = cleaning.fit_quantiles(df, [cleaning.Quantile("Monthly_Balance", 0.997, "cut")], rel_err)["cut"]
    return cut, cleaning.fit_caps(_plausible(df, cut), dict.fromkeys((*CAPPED_COUNTS, CAPPED_RATE), 0.95), rel_err)


def _coded_mix(df: DataFrame) -> DataFrame:
    return df.withColumn("Credit_Mix", recode(F.col("Credit_Mix"), "_", "Invalid"))


def financial_flags(df: DataFrame, vocab: Vocabularies = Vocabularies()) -> DataFrame:
    """Loan types, credit mix and payment behaviour as numbers; the text columns dropped."""
    coded = _coded_mix(df).withColumns(
        {
            "Spending_Level": spending_level(F.col("Payment_Behaviour")),
            "Payment_Size": payment_size(F.col("Payment_Behaviour")),
        }
    )
    vocab = vocab.completed(coded)
    flagged = encoding.multi_hot(coded, "Type_of_Loan", "loan_type", vocab.loan_types)
    flagged = encoding.one_hot(flagged, "Credit_Mix", vocab.credit_mix)
    flagged = encoding.one_hot(flagged, "Payment_of_Min_Amount", vocab.min_payment)
    return drop_columns(flagged, FINANCIAL_LEFTOVERS)


def financials(numbers: DataFrame, vocab: Vocabularies = Vocabularies(), rel_err: float = 0.0, fitted: Fitted | None = None) -> DataFrame:
    """Features from financials whose numbers are read."""
    return financial_flags(financial_outliers(numbers, rel_err, fitted), fitted.vocab if fitted else vocab)


def _coded_person(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "Occupation": recode_unmatched(F.col("Occupation"), HAS_LETTER, "Others"),
            "has_SSN": pattern_flag(F.col("SSN")),
        }
    )


def attributes(bronze: DataFrame, vocab: Vocabularies = Vocabularies(), rel_err: float = 0.0, fitted: Fitted | None = None) -> DataFrame:
    """Occupation flags, SSN validity and a plausible age; personal text dropped."""
    vocab, median = (fitted.vocab, fitted.age_median) if fitted else (vocab, None)
    coded = _coded_person(bronze)
    if vocab.occupations is None or median is None:
        # both passes of the fit and the result read the parsed columns
        coded = materialized(cleaning.read_digits(coded, "Age").drop("SSN", "Name"))
    flagged = encoding.one_hot(coded, "Occupation", vocab.occupations)
    return drop_columns(cleaning.impute_median(flagged, "Age", rel_err=rel_err, median=median), ATTRIBUTE_LEFTOVERS)


def customer_features(
    bronze_financials: DataFrame,
    bronze_attributes: DataFrame | None,
    vocab: Vocabularies = Vocabularies(),
    rel_err: float = 0.0,
    parsed: bool = False,
    fitted: Fitted | None = None,
) -> DataFrame:
    """Financial features, joined to the attributes of the same customer and snapshot if given.

    ``parsed`` says that the financials come with their numbers read already. ``fitted`` takes the place of all that would be
    learnt from these rows.
    """
    numbers = bronze_financials if parsed else financial_numbers(bronze_financials)
    money = financials(numbers, vocab, rel_err, fitted)
    if bronze_attributes is None:
        return money
    return equi_join(money, attributes(bronze_attributes, vocab, rel_err, fitted), ["Customer_ID", "snapshot_date"])


def fit_customers(numbers: DataFrame, bronze_attributes: DataFrame | None, vocab: Vocabularies = Vocabularies(), rel_err: float = 0.0) -> Fitted:
    """Learn the caps, the median age and the vocabularies that are not given. The categories are those of the rows that
    remain without outliers."""
    cut, caps = _fit_outliers(numbers, rel_err)
    vocab, median = vocab.completed(_coded_mix(_plausible(numbers, cut))), None
    if bronze_attributes is not None:
        people = materialized(cleaning.read_digits(_coded_person(bronze_attributes), "Age").select("Age", "Occupation"))
        median = cleaning.fit_median(people, "Age", rel_err)
        if vocab.occupations is None:
            vocab = replace(vocab, occupations=encoding.vocabulary(people, "Occupation"))
    return Fitted(cut, caps, median, vocab)


def unseen_categories(numbers: DataFrame, bronze_attributes: DataFrame | None, fitted: Fitted) -> DataFrame:
    """(`column`, `value`, `n_rows`): categories in the data that the fitted vocabularies lack; their flags are all 0."""
    coded = _coded_mix(numbers)
    columns = {
        "Type_of_Loan": (coded, split_list(F.col("Type_of_Loan")), [*(fitted.vocab.loan_types or ()), NO_LOAN]),
        "Credit_Mix": (coded, F.array("Credit_Mix"), fitted.vocab.credit_mix or ()),
        "Payment_of_Min_Amount": (coded, F.array("Payment_of_Min_Amount"), fitted.vocab.min_payment or ()),
    }
    if bronze_attributes is not None:
        columns["Occupation"] = (_coded_person(bronze_attributes), F.array("Occupation"), fitted.vocab.occupations or ())
    found = None
    for name, (df, values, seen) in columns.items():
        values = df.select(F.lit(name).alias("column"), F.explode(F.array_distinct(values)).alias("value"))
        new = values.where(F.col("value").isNotNull() & ~F.col("value").isin([F.lit(v) for v in seen]))
        found = new if found is None else found.unionByName(new)
    return found.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
