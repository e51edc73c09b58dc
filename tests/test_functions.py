"""Column expressions on the edge rows each must get right, with ANSI mode on."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from creditmart.functions import arrays, casting, text
from creditmart.functions.dates import ModelWindows, month_starts
from creditmart.operators.labels import add_delinquency, default_labels


def one(spark, values, kind, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("c"))).collect()]


def test_session_is_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_parse_number(spark):
    values = ["52312.68_", "-100", "_", None, "1.2E7", "", "1.2.3"]
    assert one(spark, values, "string", text.parse_number) == [52312.68, 100.0, None, None, 1.27, None, None]


def test_parse_count_keeps_s_in_the_pattern(spark):
    got = one(spark, ["3_", "3s", "-1", "3.5"], "string", lambda c: text.parse_count(c, text.DIGITS_S_AND_DOT))
    assert got == [3, None, 1, 3]


def test_parse_months(spark):
    values = ["10 Years and 9 Months", "1 Year and 1 Month", "7 Months", "NA", None]
    assert one(spark, values, "string", text.parse_months) == [129, 13, 7, 0, 0]


def test_split_list_trims(spark):
    values = ["Auto Loan, and Personal Loan", "", None, "Not Specified, Payday Loan,  and Student Loan", " , "]
    assert one(spark, values, "string", arrays.split_list) == [
        ["Auto Loan", "Personal Loan"],
        ["No loan"],
        ["No loan"],
        ["Not Specified", "Payday Loan", "Student Loan"],
        ["No loan"],
    ]


def test_trim_each_trims_every_position(spark):
    got = one(spark, ["0 a, 1 b,2 c "], "string", lambda c: arrays.trim_each(F.split(c, ",")))
    assert got == [["0 a", "1 b", "2 c"]]


def test_behaviour_codes(spark):
    values = ["High_spent_Small_value_payments", "Low_spent_Large_value_payments", "!@9#%8", None, "high_medium"]
    assert one(spark, values, "string", text.spending_level) == [1, 0, -1, -1, -1]
    assert one(spark, values, "string", text.payment_size) == [1, 3, 0, 0, 0]


def test_pattern_flag(spark):
    assert one(spark, [None, "#F%", "123-45-6789", "x123-45-67890"], "string", text.pattern_flag) == [1, 0, 1, 1]


def test_recodes(spark):
    got = one(spark, ["_______", "Engineer", None], "string", lambda c: text.recode_unmatched(c, text.HAS_LETTER, "Others"))
    assert got == ["Others", "Engineer", None]
    assert one(spark, ["_", "Good", None], "string", lambda c: text.recode(c, "_", "Invalid")) == ["Invalid", "Good", None]


def test_integer_cast_truncates_text(spark):
    values = ["3", "3.9", "-3.9", "", "x", "99999999999", None]
    assert one(spark, values, "string", lambda c: casting.cast_or_null(c, "int")) == [3, 3, -3, None, None, None, None]


@pytest.mark.parametrize(
    ("due", "overdue", "snapshot", "want"),
    [
        (100.0, 0.0, "2024-03-31", (0, None, 0, 0)),
        (100.0, 100.0, "2024-03-31", (1, date(2024, 2, 29), 31, 1)),
        (100.0, 150.0, "2024-07-01", (2, date(2024, 5, 1), 61, 1)),
        (None, 50.0, "2024-07-01", (0, None, None, 0)),
        (0.0, 50.0, "2024-07-01", (0, None, None, 0)),
        (100.0, None, "2024-07-01", (0, None, 0, 0)),
    ],
)
def test_days_past_due(spark, due, overdue, snapshot, want):
    rows = spark.createDataFrame(
        [("l", "c", 6, due, overdue, date.fromisoformat(snapshot))],
        "loan_id string, Customer_ID string, mob int, due_amt float, overdue_amt float, snapshot_date date",
    )
    loans = add_delinquency(rows)
    row, label = loans.first(), default_labels(loans, 30, 6).first()
    assert (row.installments_missed, row.first_missed_date, row.dpd, label.label) == want
    assert label.label_def == "30dpd_6mob"
    assert row.due_amt == (due or 0.0)


def test_month_starts():
    assert [str(d) for d in month_starts("2023-01-15", "2023-04-01")] == [
        "2023-01-01", "2023-02-01", "2023-03-01", "2023-04-01",
    ]
    assert month_starts("2023-12-01", "2024-01-31") == [date(2023, 12, 1), date(2024, 1, 1)]
    assert month_starts("2023-02-01", "2023-01-31") == []


def test_model_windows(spark):
    w = ModelWindows("2024-09-01")
    row = spark.range(1).select(w.train_start, w.train_end, w.oot_start, w.oot_end).first()
    assert [str(d) for d in row] == ["2023-07-01", "2024-06-30", "2024-07-01", "2024-08-31"]
