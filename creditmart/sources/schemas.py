"""Schemas of the source files and datamart tables.

Dirty fields are read as text and typed in the silver layer, so a bad cell never fails an ingest and
reading needs no inference pass.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DoubleType, FloatType, IntegerType, StringType, StructField, StructType,
)


def _struct(types: dict) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


# Column names and types of the loan ledger.
LOAN_TYPES = {
    "loan_id": StringType(),
    "Customer_ID": StringType(),
    "loan_start_date": DateType(),
    "tenure": IntegerType(),
    "installment_num": IntegerType(),
    "loan_amt": FloatType(),
    "due_amt": FloatType(),
    "paid_amt": FloatType(),
    "overdue_amt": FloatType(),
    "balance": FloatType(),
    "snapshot_date": DateType(),
}

# Columns of the financials file.
FINANCIAL_TYPES = {
    "Customer_ID": StringType(),
    "Annual_Income": StringType(),
    "Monthly_Inhand_Salary": DoubleType(),
    "Num_Bank_Accounts": IntegerType(),
    "Num_Credit_Card": IntegerType(),
    "Interest_Rate": DoubleType(),
    "Num_of_Loan": StringType(),
    "Type_of_Loan": StringType(),
    "Delay_from_due_date": IntegerType(),
    "Num_of_Delayed_Payment": StringType(),
    "Changed_Credit_Limit": StringType(),
    "Num_Credit_Inquiries": DoubleType(),
    "Credit_Mix": StringType(),
    "Outstanding_Debt": StringType(),
    "Credit_Utilization_Ratio": DoubleType(),
    "Credit_History_Age": StringType(),
    "Payment_of_Min_Amount": StringType(),
    "Total_EMI_per_month": DoubleType(),
    "Amount_invested_monthly": StringType(),
    "Payment_Behaviour": StringType(),
    "Monthly_Balance": StringType(),
    "snapshot_date": DateType(),
}

# Columns of the attributes file.
ATTRIBUTE_TYPES = {
    "Customer_ID": StringType(),
    "Name": StringType(),
    "Age": StringType(),
    "SSN": StringType(),
    "Occupation": StringType(),
    "snapshot_date": DateType(),
}

# Columns of the clickstream and of the label store.
CLICKSTREAM_FEATURES = [f"fe_{i}" for i in range(1, 21)]
CLICKSTREAM_TYPES = {
    **{name: FloatType() for name in CLICKSTREAM_FEATURES},
    "Customer_ID": StringType(),
    "snapshot_date": DateType(),
}

LABEL_TYPES = {
    "loan_id": StringType(),
    "Customer_ID": StringType(),
    "label": IntegerType(),
    "label_def": StringType(),
    "snapshot_date": DateType(),
}


def as_text(types: dict) -> StructType:
    """The columns as they stand in a file: all text but the snapshot date."""
    return _struct({c: t if isinstance(t, DateType) and c == "snapshot_date" else StringType() for c, t in types.items()})


LOAN_FILE = as_text(LOAN_TYPES)
FINANCIAL_FILE = as_text(FINANCIAL_TYPES)
ATTRIBUTE_FILE = _struct(ATTRIBUTE_TYPES)
CLICKSTREAM_FILE = as_text(CLICKSTREAM_TYPES)
LABEL_SCHEMA = _struct(LABEL_TYPES)
CLICKSTREAM_SCHEMA = _struct(CLICKSTREAM_TYPES)
LOAN_DAILY_SCHEMA = _struct(
    LOAN_TYPES
    | {
        "mob": IntegerType(),
        "installments_missed": IntegerType(),
        "first_missed_date": DateType(),
        "dpd": IntegerType(),
    }
)
