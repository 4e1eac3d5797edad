import pytest

from shopgrain.plans import (
    CLEANING_STEPS,
    TRANSFORM_STEPS,
    apply_step,
    run_cleaning,
    run_transforms,
    select_tables,
)
from shopgrain.plans import saving
from shopgrain.plans.saving import clear, new_folder, saved, saved_and_counted, shared_folder


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [(1.0, "a", -5.0), (1.2, "b", 5.0), (None, "c", 1.0), (2.0, "null", None)],
        "id double, name string, zip double",
    )


CONFIG = {
    "customer": {
        "remove_duplicates": {"columns": ["id"]},
        "remove_decimal": {"columns": ["id", "zip"]},
        "handle_negative_values": {"columns": ["zip"]},
        "impute_nulls": {
            "columns": ["name", "zip"],
            "method": "constant",
            "value": "Not Available",
        },
        "drop_nulls": {"columns": ["id"]},
        "convert_column_type": [
            {"column": "id", "target_type": "int"},
            {"column": "zip", "target_type": "string"},
        ],
    }
}


def test_steps_run_in_the_configured_order(customers, values):
    result = run_cleaning({"customer": customers}, CONFIG)
    cleaned = result.tables["customer"]
    assert cleaned.dtypes == [("id", "int"), ("name", "string"), ("zip", "string")]
    # Duplicates are removed before flooring, so two rows get the key 1; the text
    # fill does not fit the number, so the unknown zip stays null.
    assert sorted(values(cleaned), key=repr) == [
        (1, "a", "5"),
        (1, "b", "5"),
        (2, "Not Available", None),
    ]


def test_rejected_rows_and_archive(customers, spark, tmp_path):
    archive = {"archive_folder": str(tmp_path), "archive_df_name": "customer"}
    config = {
        "customer": {"drop_nulls": {"columns": ["id"], **archive}},
        "clean": {"drop_nulls": {"columns": ["id"], **archive, "archive_df_name": "x"}},
        "unnamed": {"drop_nulls": {"columns": ["id"]}},
    }
    dataset = {
        "customer": customers,
        "clean": customers.where("id IS NOT NULL"),
        "unnamed": customers,
    }
    result = run_cleaning(dataset, config)
    assert result.rejected["customer"][0].rows.count() == 1
    assert result.rejected["unnamed"][0].path is None
    assert result.write_rejected() == [f"{tmp_path}/df_customer_removed.csv"]
    archived = spark.read.csv(f"{tmp_path}/df_customer_removed.csv", header=True)
    assert [tuple(r) for r in archived.collect()] == [(None, "c", "1.0")]


def test_report_of_a_chain(customers, values):
    result = run_cleaning({"customer": customers}, CONFIG)
    changes = {(c, m): (b, a) for _, c, m, b, a in values(result.changes)}
    assert changes == {
        ("id", "Null Count"): ("1", "0"),
        ("id", "Data Type Change"): ("double", "int"),
        ("name", "Null Count"): ("1", "0"),
        ("zip", "Negative Count"): ("1", "0"),
        ("zip", "Data Type Change"): ("double", "string"),
    }
    assert values(result.summary) == [("customer", 4, 3, 0, 3, 3, 0)]


def test_unconfigured_tables_pass_through(customers):
    result = run_cleaning({"other": customers}, CONFIG)
    assert result.tables["other"] is customers
    assert run_transforms({"other": customers}, {"other": None})["other"] is customers


def test_unknown_steps(customers):
    config = {"customer": {"polish": {"columns": ["id"]}}}
    with pytest.raises(ValueError, match="unknown step 'polish'"):
        run_cleaning({"customer": customers}, config)
    result = run_cleaning({"customer": customers}, config, on_unknown="warn")
    assert result.tables["customer"] is customers
    with pytest.raises(ValueError, match="on_unknown"):
        run_transforms({"customer": customers}, config, on_unknown="ignore")


def test_steps_without_parameters_are_skipped(customers):
    config = {"customer": {"remove_duplicates": None, "drop_nulls": {}}}
    assert run_cleaning({"customer": customers}, config).tables["customer"] is customers


def test_empty_results_are_kept_unless_asked(customers):
    step = CLEANING_STEPS["handle_negative_values"]
    params = {"columns": ["zip"], "operation": "drop"}
    negative = customers.where("zip < 0")
    assert apply_step(negative, step, params).count() == 0
    assert apply_step(negative, step, params, keep_input_if_empty=True).count() == 1


def test_transforms(spark, values):
    orders = spark.createDataFrame([("Reno, NV 1", None)], "ship string, bill string")
    config = {"orders": {"add_state_columns": {"shipping_col": "ship", "billing_col": "bill"}}}
    found = run_transforms({"orders": orders}, config)["orders"]
    assert values(found, "shipping_state", "billing_state") == [("NV", "Not Available")]
    assert set(TRANSFORM_STEPS) == {"add_age_column", "add_state_columns"}


def test_saved_tables_are_read_back(customers, spark):
    result = run_cleaning({"customer": customers}, CONFIG, save=True)
    cleaned = result.tables["customer"]
    assert cleaned.count() == 3
    assert cleaned.inputFiles()[0].startswith(f"file://{shared_folder(spark)}/shopgrain-")
    assert saved(customers, "x").count() == 4


def test_select_tables(customers):
    dataset = {"df_data_a": customers, "df_data_b": customers}
    assert list(select_tables(dataset, ["b", "a"], "df_data_")) == ["b", "a"]
    with pytest.raises(ValueError, match="df_data_c"):
        select_tables(dataset, {"a": None, "c": None}, "df_data_")


def test_reports_and_archives_do_not_run_the_chain_again(spark, customers, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    slow = customers.mapInArrow(counted, customers.schema)
    steps = {"drop_nulls": {"columns": ["id"], "archive_folder": str(tmp_path), "archive_df_name": "x"}}
    result = run_cleaning({"customer": slow}, {"customer": steps}, save=True)
    once = runs.value
    result.changes.count(), result.summary.count(), result.changes.count()
    profiled = runs.value - once
    assert profiled == customers.count()  # the source's own profile, once
    assert result.write_rejected()
    assert runs.value - once - profiled <= customers.count()


def test_rows_are_counted_while_they_are_written(spark):
    for n in (0, 1, 2000):
        df, rows = saved_and_counted(spark.range(n).where("id >= 0"), "counted")
        assert rows == n == df.count()
    _, rows = saved_and_counted(spark.createDataFrame([], "a int"), "none")
    assert rows == 0
    _, rows = saved_and_counted(spark.range(9).where("false"), "none")
    assert rows == 0


def test_working_files_are_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("shopgrain.saving.shared_folder", lambda _: str(tmp_path))
    saved(spark.range(3), "x")
    assert new_folder(spark).startswith(str(tmp_path)) and any(tmp_path.iterdir())
    clear(spark)
    assert not any(tmp_path.iterdir())
    clear(spark)


def test_a_folder_of_the_driver_is_refused_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {"spark.sql.warehouse.dir": "file:/home/me/warehouse"}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
    Session.conf = {"spark.sql.warehouse.dir": "s3a://bucket/warehouse/"}
    assert shared_folder(Session()) == "s3a://bucket/warehouse"
    Context.master = "local[4]"
    Session.conf = {"spark.sql.warehouse.dir": "/tmp/w"}
    assert shared_folder(Session()) == "/tmp/w"


def test_both_reports_share_one_written_profile(spark, customers, monkeypatch):
    written = []
    real = saving.saved
    monkeypatch.setattr(
        "shopgrain.plans.chains.saved", lambda df, name: written.append(name) or real(df, name)
    )
    result = run_cleaning({"customer": customers}, {})
    assert result.changes.count() == 0 and result.summary.count() == 1
    assert written == ["profiles"]
