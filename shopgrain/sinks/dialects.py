"""SQL texts of the databases: types, table creation and merges."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*)*")


@dataclass(frozen=True)
class Dialect:
    """How one kind of database spells what an upsert needs.

    ``column_types`` maps Spark type classes to SQL types; decimals keep their
    precision; all other types are stored as ``text_type``. ``spell`` writes a
    table or column name. ``insert_on_conflict`` selects ``INSERT ... ON CONFLICT``
    over ``MERGE``.
    """

    name: str
    column_types: dict[type[T.DataType], str]
    decimal_type: str
    text_type: str
    spell: Callable[[str], str]
    insert_on_conflict: bool = False

    def type_for(self, dtype: T.DataType) -> str:
        if isinstance(dtype, T.DecimalType):
            return f"{self.decimal_type}({dtype.precision},{dtype.scale})"
        return self.column_types.get(type(dtype), self.text_type)

    def identifier(self, name: str) -> str:
        if not IDENTIFIER.fullmatch(name):
            raise ValueError(f"{name!r} cannot be used as a table or column name")
        return ".".join(self.spell(part) for part in name.split("."))

    def identifiers(self, names: Sequence[str]) -> list[str]:
        return [self.identifier(n) for n in names]

    def create_sql(self, schema: T.StructType, table: str, keys: Sequence[str]) -> str:
        """``CREATE TABLE`` with the keys as primary key."""
        _require_keys(schema.names, table, keys)
        lines = [
            f"{self.identifier(f.name)} {self._key_type(f, keys)}" for f in schema
        ]
        lines.append(f"PRIMARY KEY ({', '.join(self.identifiers(keys))})")
        return f"CREATE TABLE {self.identifier(table)} ({', '.join(lines)})"

    def _key_type(self, field: T.StructField, keys: Sequence[str]) -> str:
        sql_type = self.type_for(field.dataType)
        return f"{sql_type} NOT NULL" if field.name in keys else sql_type

    def upsert_sql(
        self, table: str, stage: str, columns: Sequence[str], keys: Sequence[str]
    ) -> str:
        """One statement that merges a stage table into its target.

        ``SELECT DISTINCT`` makes it safe against a stage part that was written
        twice because its executor was lost after the commit.
        """
        _require_keys(columns, table, keys)
        names, key_names = self.identifiers(columns), self.identifiers(keys)
        others = [n for n in names if n not in key_names]
        listed = ", ".join(names)
        rows = f"SELECT DISTINCT {listed} FROM {self.identifier(stage)}"
        target = self.identifier(table)
        if self.insert_on_conflict:
            updates = ", ".join(f"{n} = EXCLUDED.{n}" for n in others)
            action = f"DO UPDATE SET {updates}" if others else "DO NOTHING"
            return (
                f"INSERT INTO {target} ({listed}) {rows} "
                f"ON CONFLICT ({', '.join(key_names)}) {action}"
            )
        same_key = " AND ".join(f"target.{k} = source.{k}" for k in key_names)
        updates = ", ".join(f"{n} = source.{n}" for n in others)
        matched = f"WHEN MATCHED THEN UPDATE SET {updates} " if others else ""
        values = ", ".join(f"source.{n}" for n in names)
        return (
            f"MERGE INTO {target} AS target USING ({rows}) AS source ON {same_key} "
            f"{matched}WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({values})"
        )

    def drop_sql(self, table: str) -> str:
        return f"DROP TABLE {self.identifier(table)}"


def _require_keys(columns: Sequence[str], table: str, keys: Sequence[str]) -> None:
    if not keys:
        raise ValueError(f"no key columns are given for table {table!r}")
    missing = [k for k in keys if k not in columns]
    if missing:
        raise ValueError(f"key columns {missing} are not in table {table!r}")


def _quoted(name: str) -> str:
    return f'"{name}"'


# SQL types per Spark type.
_COMMON_TYPES = {
    T.IntegerType: "INTEGER",
    T.ShortType: "SMALLINT",
    T.ByteType: "SMALLINT",
    T.LongType: "BIGINT",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
}

POSTGRES = Dialect(
    name="postgres",
    column_types={
        **_COMMON_TYPES,
        T.DoubleType: "DOUBLE PRECISION",
        T.FloatType: "REAL",
        T.TimestampType: "TIMESTAMP",
        T.BinaryType: "BYTEA",
    },
    decimal_type="NUMERIC",
    text_type="TEXT",
    spell=_quoted,
    insert_on_conflict=True,
)

ANSI = Dialect(
    name="ansi",
    column_types={
        **_COMMON_TYPES,
        T.DoubleType: "DOUBLE PRECISION",
        T.FloatType: "REAL",
        T.TimestampType: "TIMESTAMP",
    },
    decimal_type="DECIMAL",
    text_type="VARCHAR(32672)",
    spell=_quoted,
)

SNOWFLAKE = Dialect(
    name="snowflake",
    column_types={
        **_COMMON_TYPES,
        T.DoubleType: "DOUBLE",
        T.FloatType: "FLOAT",
        T.TimestampType: "TIMESTAMP_LTZ",
        T.BinaryType: "BINARY",
    },
    decimal_type="NUMBER",
    text_type="VARCHAR",
    spell=str.upper,
)

DIALECTS = {d.name: d for d in (POSTGRES, ANSI, SNOWFLAKE)}
