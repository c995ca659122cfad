import datetime

import pytest

from tellerlake.functions import bands, calendar, casts, ids

D = datetime.date


def apply(spark, kind, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.selectExpr("i", f"{expression} AS y").orderBy("i").collect()]


def test_age_band(spark):
    ages = ["24", "25", "34", "35", "44", "45", "54", "55", "64", "65", None, "abc", "24.5"]
    got = apply(spark, "string", ages, bands.age_band(casts.to_integer("x")))
    assert got == [
        "Under 25", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55-64", "55-64", "65+", "65+", "65+",
        "Under 25",
    ]


def test_amount_band(spark):
    amounts = [99.99, 100.0, 499.99, 500.0, 999.99, 1000.0, 4999.99, 5000.0, 19999.99, 20000.0, 0.0, -1.0, None]
    assert apply(spark, "double", amounts, bands.amount_band("x")) == [
        "Under R100", "R100-R500", "R100-R500", "R500-R1k", "R500-R1k", "R1k-R5k", "R1k-R5k", "R5k-R20k", "R5k-R20k",
        "Over R20k", "Under R100", "Under R100", "Over R20k",
    ]


def test_fraud_band(spark):
    scores = [0.0, 0.299, 0.3, 0.599, 0.6, 0.799, 0.8, 1.0, None]
    assert apply(spark, "double", scores, bands.fraud_risk_band("x")) == [
        "Low", "Low", "Medium", "Medium", "High", "High", "Critical", "Critical", "Critical",
    ]


def test_hours(spark):
    times = ["05:59:59", "06:00:00", "08:59:59", "09:00:00", "17:59:59", "18:00:00", "21:59:59", "22:00:00", "xx", None]
    hour = casts.hour_of("x")
    assert apply(spark, "string", times, hour) == [5, 6, 8, 9, 17, 18, 21, 22, None, None]
    assert apply(spark, "string", times, bands.is_night(hour)) == [
        True, False, False, False, False, False, False, True, None, None,
    ]
    assert apply(spark, "string", times, bands.is_business_hours(hour)) == [
        False, False, False, True, True, False, False, False, None, None,
    ]


def test_status_flags(spark):
    statuses = ["Completed", "Failed", "Declined - Blocked", "Pending", None]
    assert apply(spark, "string", statuses, bands.is_declined("x")) == [False, True, True, False, None]
    assert apply(spark, "string", statuses, bands.is_completed("x")) == [True, False, False, False, None]


@pytest.mark.parametrize(
    "text, number",
    [("1234", 1234), ("1234.0", 1234), (" 7 ", 7), ("-3.9", -3), (".5", 0), ("2147483648", None), ("1e3", None),
     ("1d", None), ("abc", None), ("", None), (None, None), ("NaN", None)],
)
def test_to_integer(spark, text, number):
    assert apply(spark, "string", [text], casts.to_integer("x")) == [number]


def test_other_casts(spark):
    assert apply(spark, "string", ["True", "1", "false", "maybe", None], casts.to_boolean("x")) == [
        True, True, False, None, None,
    ]
    assert apply(spark, "string", ["1.5", "NaN", "x", None], casts.to_double("x")) == [1.5, None, None, None]
    days = ["2024-02-29", "2023-02-29", "2024-1-2", "2024/01/02", None]
    assert apply(spark, "string", days, casts.to_day("x")) == [D(2024, 2, 29), None, None, None, None]


def test_null_tokens(spark):
    texts = ["", "NA", "N/A", "null", "NULL", "None", "nan", "NaN", " ", "none", "0", None]
    assert apply(spark, "string", texts, casts.null_tokens_to_null("x")) == [None] * 8 + [" ", "none", "0", None]


def test_calendar_edges(spark):
    days = [D(2024, 2, 29), D(2024, 3, 1), D(2021, 1, 3), D(2024, 12, 31), D(2024, 11, 30), D(2024, 1, 31)]
    assert apply(spark, "date", days, calendar.date_key("x")) == [
        20240229, 20240301, 20210103, 20241231, 20241130, 20240131,
    ]
    assert apply(spark, "date", days, calendar.fiscal_year("x")) == [2023, 2024, 2020, 2024, 2024, 2023]
    assert apply(spark, "date", days, calendar.fiscal_quarter("x")) == [4, 1, 4, 4, 3, 4]
    assert apply(spark, "date", days, calendar.is_month_end("x")) == [True, False, False, True, True, True]
    assert apply(spark, "date", days, calendar.is_quarter_end("x")) == [False, False, False, True, False, False]
    assert apply(spark, "date", days, calendar.is_year_end("x")) == [False, False, False, True, False, False]
    assert apply(spark, "date", days, calendar.iso_day_of_week("x")) == [4, 5, 7, 2, 6, 3]
    assert apply(spark, "date", days, calendar.is_weekend("x")) == [False, False, True, False, True, False]


def test_ids(spark):
    numbers = [7, 999999, 1234567]
    assert apply(spark, "bigint", numbers, ids.format_id("customers", "x")) == ["CUS000007", "CUS999999", "CUS1234567"]
    assert apply(spark, "string", ["CUS000007", "none"], ids.id_number("x")) == [7, None]
    assert apply(spark, "string", ["abcdef0123"], ids.short_reference("x")) == ["ABCDEF01"]


def test_money_direction(spark):
    kinds = ["Purchase", "Salary Credit", "EFT Transfer In", "Reversal", "Bank Charges"]
    assert apply(spark, "string", kinds, bands.is_debit_type("x")) == [True, False, False, False, True]
    assert apply(spark, "string", kinds, bands.signed_amount("5", bands.is_debit_type("x"))) == [-5, 5, 5, 5, -5]
    assert apply(spark, "string", ["Durban", "Paarl"], bands.branch_region("x")) == ["Urban", "Suburban"]
