"""Row-local steps take a streaming DataFrame as they are."""

from shopgrain import operators as op
from suite.views import view

SF_DIR = "/root/testdata/sf0.001"


def clean(df):
    df = op.remove_decimal(df, ["customer_id", "zip_code"])
    df = op.handle_negative_values(df, ["zip_code"])
    df = op.validate_emails(df, "email", "Invalid Email")
    df = op.clean_phone_numbers(df, "phone_number")
    df = op.standardize_date_format(df, "birth_date")
    df = op.impute_nulls(df, ["first_name"], "constant", "Not Available")
    df = op.drop_nulls(df, ["last_name"])
    return op.convert_column_type(df, "birth_date", "date")


def test_stream_equals_batch(spark, tmp_path):
    raw = view(spark, SF_DIR, "raw_customer")
    raw.write.parquet(str(tmp_path / "in"))
    stream = clean(spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in")))
    query = (
        stream.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    found = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    expected = clean(raw)
    assert found.exceptAll(expected).isEmpty()
    assert expected.exceptAll(found).isEmpty()
