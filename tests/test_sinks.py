"""Writers. No database runs here: SQL texts and the calls made are checked."""

from unittest import mock

import pytest

from shopgrain.sinks import (
    ANSI,
    POSTGRES,
    SNOWFLAKE,
    Warehouse,
    archive_path,
    create_table,
    database,
    jdbc_loader,
    upsert_all,
    upsert_jdbc,
    warehouse_loader,
    write_archive,
)
from shopgrain.sources import jdbc

ALL_TYPES = (
    "s string, i int, l bigint, h smallint, y tinyint, f float, d double, b boolean, "
    "t timestamp, n timestamp_ntz, day date, m decimal(12,2), a array<int>"
)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "c")], "id int, name string"
    )


def test_create_table_sql(spark):
    schema = spark.createDataFrame([], ALL_TYPES).schema
    assert POSTGRES.create_sql(schema, "shop", ["i", "l"]) == (
        'CREATE TABLE "shop" ("s" TEXT, "i" INTEGER NOT NULL, "l" BIGINT NOT NULL, '
        '"h" SMALLINT, "y" SMALLINT, "f" REAL, "d" DOUBLE PRECISION, "b" BOOLEAN, '
        '"t" TIMESTAMP, "n" TIMESTAMP, "day" DATE, "m" NUMERIC(12,2), "a" TEXT, '
        'PRIMARY KEY ("i", "l"))'
    )
    assert SNOWFLAKE.create_sql(schema, "x", ["i"]).startswith(
        "CREATE TABLE X (S VARCHAR, I INTEGER NOT NULL, L BIGINT"
    )
    assert '"m" DECIMAL(12,2)' in ANSI.create_sql(schema, "x", ["i"])


def test_postgres_upsert_sql():
    assert POSTGRES.upsert_sql("t", "st", ["id", "a", "b"], ["id"]) == (
        'INSERT INTO "t" ("id", "a", "b") SELECT DISTINCT "id", "a", "b" FROM "st" '
        'ON CONFLICT ("id") DO UPDATE SET "a" = EXCLUDED."a", "b" = EXCLUDED."b"'
    )
    assert POSTGRES.upsert_sql("t", "st", ["id"], ["id"]).endswith("DO NOTHING")


def test_merge_sql():
    assert SNOWFLAKE.upsert_sql("db.sc.t", "db.sc.st", ["id", "k", "a"], ["id", "k"]) == (
        "MERGE INTO DB.SC.T AS target USING (SELECT DISTINCT ID, K, A FROM DB.SC.ST) "
        "AS source ON target.ID = source.ID AND target.K = source.K "
        "WHEN MATCHED THEN UPDATE SET A = source.A "
        "WHEN NOT MATCHED THEN INSERT (ID, K, A) "
        "VALUES (source.ID, source.K, source.A)"
    )
    assert "WHEN MATCHED" not in ANSI.upsert_sql("t", "st", ["id"], ["id"])


def test_keys_and_names_are_checked():
    with pytest.raises(ValueError, match="no key columns"):
        POSTGRES.upsert_sql("t", "st", ["id"], [])
    with pytest.raises(ValueError, match="not in table"):
        POSTGRES.upsert_sql("t", "st", ["id"], ["k"])
    with pytest.raises(ValueError, match="cannot be used"):
        POSTGRES.upsert_sql('t"; DROP TABLE x', "st", ["id"], ["id"])


def test_stage_names_differ():
    assert database.stage_name("t") != database.stage_name("t")


@pytest.fixture
def calls(monkeypatch):
    """Record what an upsert would do to a database."""
    made = []

    def write_stage(df, url, table, properties):
        made.append(("write", table, sorted(tuple(r) for r in df.collect())))

    monkeypatch.setattr(database, "write_stage", write_stage)
    monkeypatch.setattr(database, "table_exists", lambda *a: made.append("ask") or False)
    return made


def test_upsert_jdbc_order_of_work(rows, calls):
    done = upsert_jdbc(
        rows, "jdbc:x", "shop", ["id"], POSTGRES, {}, run_sql=lambda s: calls.append(list(s))
    )
    assert done == "created"
    ask, create, (kind, stage, staged), (merge, drop) = calls
    assert ask == "ask"
    assert create[0].startswith('CREATE TABLE "shop"')
    assert kind == "write"
    assert staged == [(1, "a"), (2, "c")]  # one row per key
    assert merge.startswith('INSERT INTO "shop"') and stage in merge
    assert drop == f"DROP TABLE {stage}"


def test_upsert_jdbc_into_a_known_table(rows, calls, monkeypatch):
    monkeypatch.setattr(database, "table_exists", lambda *a: True)
    run = lambda s: calls.append(list(s))
    assert upsert_jdbc(rows, "u", "shop", ["id"], ANSI, {}, run_sql=run) == "upserted"
    assert [c[0] for c in calls if isinstance(c, list)][0].startswith("MERGE INTO")


def test_loader_for_all_tables(spark, rows, calls, monkeypatch, values):
    runner = lambda *a: lambda s: calls.append(list(s))
    monkeypatch.setattr(database, "jdbc_runner", runner)
    load = jdbc_loader("jdbc:x", POSTGRES, {})
    found = upsert_all(spark, {"shop": rows}, {"shop": "id"}, load)
    assert values(found) == [("shop", "created", 3, None)]
    assert [c[0].split()[0] for c in calls if isinstance(c, list)] == ["CREATE", "INSERT"]


def test_connections_are_refused_without_a_fitting_driver(spark):
    with pytest.raises(Exception, match="No suitable driver"):
        database.jdbc_runner(spark, "jdbc:nothing:x", {"user": "u"})(["SELECT 1"])
    client = {"driver": "org.apache.hive.jdbc.HiveDriver", "user": "u"}
    with pytest.raises(ValueError, match="does not take"):
        database.jdbc_runner(spark, "jdbc:nothing:x", client)(["SELECT 1"])


class FakeConnection:
    def __init__(self, failing=False):
        self.log, self.failing = [], failing

    def __getattr__(self, name):
        def call(*args):
            self.log.append((name, *args))
            if name == "execute" and self.failing:
                raise RuntimeError("refused")
            return self

        return call


def test_statements_run_in_one_transaction(spark, monkeypatch):
    good, bad = FakeConnection(), FakeConnection(failing=True)
    monkeypatch.setattr(database, "_connect", lambda *a: good)
    database.jdbc_runner(spark, "u", {})(["A", "B"])
    assert good.log == [
        ("setAutoCommit", False),
        ("createStatement",),
        ("execute", "A"),
        ("execute", "B"),
        ("commit",),
        ("close",),
    ]
    monkeypatch.setattr(database, "_connect", lambda *a: bad)
    with pytest.raises(RuntimeError):
        database.jdbc_runner(spark, "u", {})(["A", "B"])
    assert [c[0] for c in bad.log[2:]] == ["execute", "rollback", "close"]


def test_failed_merge_raises_and_keeps_the_stage(rows, calls, monkeypatch):
    monkeypatch.setattr(database, "table_exists", lambda *a: True)

    def run(statements):
        calls.append(list(statements))
        raise RuntimeError("refused")

    with pytest.raises(RuntimeError, match="refused"):
        upsert_jdbc(rows, "u", "shop", ["id"], POSTGRES, {}, run_sql=run)
    assert len([c for c in calls if isinstance(c, list)]) == 1


def test_bad_keys_fail_before_anything_is_written(rows, calls):
    with pytest.raises(ValueError):
        upsert_jdbc(rows, "u", "shop", ["nope"], POSTGRES, {}, run_sql=calls.append)
    assert calls == []


def test_upsert_all_reports_each_table(spark, rows, values):
    def load(df, table, keys):
        if table == "bad":
            raise RuntimeError("refused")
        return f"{table} by {'+'.join(keys)}"

    dataset = {"a": rows, "b": rows, "bad": rows, "empty": rows.limit(0), "none": None}
    keys = {"a": "id", "b": ["id", "name"], "bad": "id", "empty": "id", "none": "id"}
    n = rows.count()
    assert values(upsert_all(spark, dataset, keys, load)) == [
        ("a", "a by id", n, None),
        ("b", "b by id+name", n, None),
        ("bad", "failed", n, "refused"),
        ("empty", "skipped", 0, None),
        ("none", "skipped", 0, None),
    ]
    with pytest.raises(ValueError, match="no key columns"):
        upsert_all(spark, {"a": rows}, {}, load)


class FakeReader:
    """Records reader calls and answers every load with the given rows."""

    def __init__(self, answer):
        self.answer, self.calls = answer, []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self.answer if name in ("load", "jdbc") else self

        return call


@pytest.fixture
def database_of(spark):
    def make(answer):
        return mock.Mock(read=FakeReader(answer))

    return make


def test_warehouse_creates_then_upserts(spark, rows, tmp_path, monkeypatch):
    statements = []
    warehouse = Warehouse(
        format="parquet",
        options={},
        run_sql=statements.extend,
        schema="sc",
        catalog="db",
        table_option="path",
    )
    written = []
    monkeypatch.setattr(
        "shopgrain.sinks.warehouse.create_table",
        lambda df, table, *a: written.append((table, df.count())),
    )
    load = warehouse_loader(warehouse)
    monkeypatch.setattr(Warehouse, "exists", lambda self, spark, table: False)
    assert load(rows, "shop", ["id"]) == "created"
    assert written == [("shop", 3)] and statements == []
    monkeypatch.setattr(Warehouse, "exists", lambda self, spark, table: True)
    assert load(rows, "shop", ["id"]) == "upserted"
    stage, count = written[1]
    assert count == 2
    assert statements[0].startswith("MERGE INTO DB.SC.SHOP")
    assert statements[1] == f"DROP TABLE DB.SC.{stage.upper()}"


def test_warehouse_asks_its_catalog(spark, database_of):
    warehouse = Warehouse("snowflake", {"a": "b"}, print, schema="Sc", catalog="db")
    count = spark.createDataFrame([(1,)], "n int")
    fake = database_of(count)
    assert warehouse.exists(fake, "Shop")
    queries = [a[1] for n, a, _ in fake.read.calls if n == "option" and a[0] == "query"]
    assert queries == [
        "SELECT COUNT(*) AS n FROM db.information_schema.tables "
        "WHERE UPPER(table_name) = UPPER('Shop') AND UPPER(table_schema) = UPPER('Sc')"
    ]


def test_create_table_through_a_format(rows, spark, tmp_path):
    path = str(tmp_path / "out")
    create_table(rows, path, "parquet", {"compression": "gzip"}, table_option="path")
    create_table(rows, path, "parquet", {}, table_option="path")
    assert spark.read.parquet(path).count() == 3


def test_archive(rows, spark, tmp_path):
    path = archive_path(f"{tmp_path}/", "shop")
    assert path == f"{tmp_path}/df_shop_removed.csv"
    write_archive(rows.repartition(3), path, single_file=True)
    assert len(list((tmp_path / "df_shop_removed.csv").glob("part-*"))) == 1
    write_archive(rows, path)
    assert spark.read.csv(path, header=True).count() == 3


def test_read_table_asks_for_missing_bounds(spark, database_of):
    fake = database_of(spark.createDataFrame([(3, 90)], "low int, high int"))
    split = jdbc.Partitioning("id", partitions=8)
    jdbc.read_table(fake, "jdbc:x", "shop", {"user": "u"}, split)
    name, args, options = fake.read.calls[-1]
    assert (name, args) == ("jdbc", ("jdbc:x", "shop"))
    assert options == {
        "column": "id",
        "lowerBound": 3,
        "upperBound": 90,
        "numPartitions": 8,
        "properties": {"user": "u"},
    }
    asked = [a[1] for n, a, _ in fake.read.calls if n == "option" and a[0] == "query"]
    assert asked == ["SELECT MIN(id) AS low, MAX(id) AS high FROM shop"]


def test_read_table_without_or_with_given_bounds(spark, database_of):
    fake = database_of(spark.range(1))
    jdbc.read_table(fake, "u", "shop", {})
    jdbc.read_table(fake, "u", "shop", {}, jdbc.Partitioning("id", 4, 0, 10))
    assert [c[0] for c in fake.read.calls] == ["jdbc", "jdbc"]
    assert fake.read.calls[1][2]["upperBound"] == 10


def test_load_all_tables(spark, database_of):
    fake = database_of(spark.createDataFrame([("b",), ("a",)], "table_name string"))
    tables = jdbc.load_all_tables(fake, "u", {}, schema="it's")
    assert list(tables) == ["a", "b"]
    asked = [a[1] for n, a, _ in fake.read.calls if n == "option" and a[0] == "query"]
    assert asked[0].endswith("WHERE table_schema = 'it''s'")


def test_table_exists(spark, database_of):
    one = database_of(spark.createDataFrame([(1,)], "n int"))
    none = database_of(spark.createDataFrame([(0,)], "n int"))
    assert jdbc.table_exists(one, "u", "shop", {}, "public")
    assert not jdbc.table_exists(none, "u", "shop", {})
