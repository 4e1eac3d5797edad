"""Phones, e-mails, dates, ages and states."""

from datetime import date
from random import Random

import pytest
from pyspark.sql import functions as F

from shopgrain import functions as fn
from shopgrain import operators as op
from shopgrain.functions.dates import DATE_PATTERNS

PHONES = {
    "Not Available": "Not Available",
    None: "Invalid phone number",
    "": "Invalid phone number",
    "abc": "Invalid phone number",
    "555-0123": "Invalid phone number",
    "(212) 555-0123": "+1 (212) 555-0123",
    "1-212-555-0123x45": "+1 (212) 555-0123x45",
    "1-212-555-0123X45": "+1 (212) 555-0123x45",
    "212.555.0123 ext 7": "+1 (212) 555-0123x7",
    "212.555.0123 x": "Invalid phone number",
    "212x5x6": "Invalid phone number",
    "2-212-555-0123": "Invalid phone number",
    "001-212-555-0123": "Invalid phone number",
    "001-212-555-012": "+1 (212) 555-012",
    "001-212-5555": "+1 (001) 212-5555",
    "1234567890": "+1 (123) 456-7890",
    "11234567890": "+1 (123) 456-7890",
    "٢١٢٥٥٥٠١٢٣": "+1 (٢١٢) ٥٥٥-٠١٢٣",
    "+12125550123\n": "+1 (212) 555-0123",
}


def test_phones(spark, values):
    df = spark.createDataFrame([(p,) for p in PHONES], "phone string")
    found = values(op.clean_phone_numbers(df, "phone"))
    assert dict(zip(PHONES, found, strict=True)) == PHONES


def test_long_form_of_001_on_request(spark, values):
    df = spark.createDataFrame([("001-212-555-0123",)], "phone string")
    cleaned = op.clean_phone_numbers(df, "phone", accept_001_13=True)
    assert values(cleaned) == ["+1 (212) 555-0123"]


EMAILS = {
    "a@b.c": "a@b.c",
    "first.last@sub.example.com": "first.last@sub.example.com",
    None: "bad",
    "": "bad",
    "a@b": "bad",
    "a@@b.c": "bad",
    "@b.c": "bad",
    "a@b.": "bad",
}


def test_emails(spark, values):
    df = spark.createDataFrame([(e,) for e in EMAILS], "email string")
    found = values(op.validate_emails(df, "email", "bad"))
    assert dict(zip(EMAILS, found, strict=True)) == EMAILS


DATES = {
    "05.01.2023": "2023-01-05",
    "05/01/2023": "2023-01-05",
    "05/Jan/2023": "2023-01-05",
    "05.January.2023": "2023-01-05",
    "2023-01-05": "2023-01-05",
    "05-Jan-2023": "2023-01-05",
    "12/25/2023": "2023-12-25",
    "5 Jan 2023": "Invalid Date",
    "1/2/2023": "Invalid Date",
    "31.02.2023": "Invalid Date",
    "": "Invalid Date",
    None: "Invalid Date",
}


def test_dates(spark, values):
    df = spark.createDataFrame([(d,) for d in DATES], "day string")
    found = values(op.standardize_date_format(df, "day"))
    assert dict(zip(DATES, found, strict=True)) == DATES


def test_dates_of_date_columns_and_other_target_format(spark, values):
    df = spark.sql(
        "SELECT DATE '2023-01-05' AS d, TIMESTAMP '2023-01-05 10:30:00' AS t, 7 AS i"
    )
    for column in ("d", "t"):
        written = op.standardize_date_format(df, column, "dd/MM/yyyy")
        assert values(written, column) == ["05/01/2023"]
    assert values(op.standardize_date_format(df, "i"), "i") == ["Invalid Date"]
    assert op.standardize_date_format(df, "absent").columns == df.columns
    with pytest.raises(ValueError, match="missing columns"):
        op.standardize_date_format(df, "absent", missing="raise")


def phone_by_hand(phone):
    """The phone rules, step by step."""
    if phone == "Not Available":
        return phone
    dialled = "".join(c for c in phone or "" if c.isdecimal() or c in "xX")
    number, mark, extension = dialled.lower().partition("x")
    if mark and not extension.isdecimal():
        return "Invalid phone number"
    if len(number) == 11 and number[0] == "1":
        number = number[1:]
    elif len(number) == 12 and number.startswith("001"):
        number = number[3:]
    elif len(number) != 10:
        return "Invalid phone number"
    return f"+1 ({number[:3]}) {number[3:6]}-{number[6:]}{mark}{extension}"


def test_random_phones_against_the_rules(spark, values):
    random = Random(7)
    phones = [
        random.choice(["", "1", "001", "0"])
        + "".join(random.choices("0123456789", k=random.choice([8, 9, 10, 11])))
        + random.choice(["", "x", "x1", "X22", " ext. 7", "x1x2", "abc"])
        for _ in range(3000)
    ]
    df = spark.createDataFrame([(p,) for p in phones], "phone string")
    expected = [phone_by_hand(p) for p in phones]
    assert len(set(expected)) > 500
    cleaned = op.clean_phone_numbers(df, "phone")
    assert values(cleaned) == expected
    assert values(df.select(fn.clean_phone(F.col("phone")))) == expected


def test_shapes_hide_no_date(spark, values):
    random = Random(7)

    days = ["05", "12", "31", "5", "٠٥", "005", ""]
    months = ["05", "02", "13", "Jan", "May", "January", "jan", "Sept", "Sep", "5"]
    years = ["2023", "2023", "+12023", "-0044", "0099", "99", "12023", ""]

    def pieces():
        found = [random.choice(days), random.choice(months), random.choice(years)]
        return found if random.random() < 0.7 else random.sample(found, 3)

    def separators():
        first = random.choice("./-")
        return first, first if random.random() < 0.8 else random.choice("./- ")

    texts = []
    for _ in range(6000):
        (one, two, three), (first, second) = pieces(), separators()
        texts.append(random.choice(["", "", "", " "]) + one + first + two + second + three)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_date("t", p) for p in DATE_PATTERNS])
    both = df.select(
        plain.cast("string").alias("plain"),
        fn.parse_date(F.col("t")).cast("string").alias("shaped"),
    )
    assert both.where("NOT plain <=> shaped").count() == 0
    assert both.where("plain IS NOT NULL").count() > 100


def test_age_bands(spark, values):
    ages = [0, 19, 20, 29, 30, 39, 40, 49, 50, 120, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    assert values(df.select(fn.age_band(F.col("age")))) == [
        "<20",
        "<20",
        "20-29",
        "20-29",
        "30-39",
        "30-39",
        "40-49",
        "40-49",
        "50+",
        "50+",
        "50+",
    ]


def test_ages(spark, values):
    births = [date(2023, 6, 30), date(1984, 6, 30), date(1984, 7, 1), None]
    df = spark.createDataFrame([(b,) for b in births], "born date")
    day = date(2024, 6, 30)
    aged = op.add_age_column(df, "born", as_of=day)
    assert values(aged, "age") == [1, 40, 39, None]
    year_later = op.add_age_column(df, "born", as_of=date(2024, 6, 29))
    assert values(year_later, "age")[0] == 0
    exact = op.add_age_column(df, "born", as_of=day, exact=True)
    assert values(exact, "age") == [1, 40, 39, None]
    birthday = op.add_age_column(df, "born", as_of=date(2025, 6, 30))
    assert values(birthday, "age")[0] == 2
    first = spark.sql("SELECT DATE '2022-03-01' AS born")
    early = date(2023, 3, 1)
    assert values(op.add_age_column(first, "born", as_of=early), "age") == [0]
    assert values(op.add_age_column(first, "born", as_of=early, exact=True), "age") == [1]


def test_age_of_text_dates_and_missing_column(spark, values):
    rows = [("Invalid Date",), ("1984-06-30",), ("soon",), (None,)]
    df = spark.createDataFrame(rows, "born string")
    aged = op.add_age_column(df, "born", as_of=date(2024, 6, 30))
    assert values(aged, "age") == [0, 40, None, None]
    with pytest.raises(ValueError, match="missing columns"):
        op.add_age_column(df, "birth")
    assert dict(op.add_age_column(df, "born").dtypes)["age"] == "bigint"


STATES = {
    "12 Main St, Reno, NV 89501": ("NV", "NV"),
    "PO Box 1, Reno, NV": ("Not Available", "NV"),
    "1 Rue X, Paris": ("Not Available", "Not Available"),
    "Reno, nv 89501": ("Not Available", "Not Available"),
    "CA House, Austin, TX": ("CA", "TX"),
    "USA": ("Not Available", "Not Available"),
    None: ("Not Available", "Not Available"),
}


def test_states(spark, values):
    df = spark.createDataFrame([(a,) for a in STATES], "s string").withColumn("b", F.col("s"))
    first = values(op.add_state_columns(df, "s", "b"), "shipping_state", "billing_state")
    assert first == [(f, f) for f, _ in STATES.values()]
    any_pair = op.add_state_columns(df, "s", "b", mode="any")
    assert values(any_pair, "shipping_state") == [a for _, a in STATES.values()]
    with pytest.raises(ValueError, match="mode"):
        op.add_state_columns(df, "s", "b", mode="last")


def test_fifty_states():
    assert len(set(fn.US_STATES)) == 50
