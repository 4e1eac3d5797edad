"""Cleaning and enrichment steps, one by one and as configured chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain import operators as op
from shopgrain.plans import run_cleaning, run_transforms

from . import analytics
from .registry import query
from .views import AS_OF, VIEWS, table, view


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "raw_customer")


def columns_of(name: str) -> list[str]:
    return [e.rsplit(" AS ", 1)[1] for e in VIEWS[name][1]]


def replaced(name: str, **expressions: str) -> str:
    """The select list of a view with some columns computed anew."""
    return ", ".join(
        f"{expressions[c]} AS {c}" if c in expressions else c for c in columns_of(name)
    )


# Duplicates -----------------------------------------------------------------

LINE_COLUMNS = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


def _first_line(order: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, {LINE_COLUMNS} FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {order}) AS place FROM lineitem) WHERE place = 1"""


@query("c01_remove_duplicates_by_key", _first_line(LINE_COLUMNS))
def c01(spark, d):
    return op.remove_duplicates(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query(
    "c01b_remove_duplicates_latest",
    _first_line(
        "l_shipdate DESC, "
        + ", ".join(f"{c} DESC" for c in LINE_COLUMNS.split(", ")[:-1])
    ),
)
def c01b(spark, d):
    return op.remove_duplicates(
        table(spark, d, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        order_by=["l_shipdate"],
        keep="last",
    )


@query("c01c_remove_duplicate_rows", "SELECT DISTINCT text, lang FROM documents")
def c01c(spark, d):
    return op.remove_duplicates(table(spark, d, "documents").select("text", "lang"))


# Missing values -------------------------------------------------------------


@query(
    "c02_impute_nulls_constant",
    "SELECT "
    + replaced(
        "raw_customer",
        first_name="coalesce(nullif(first_name, 'null'), 'Not Available')",
        email="coalesce(nullif(email, 'null'), 'Not Available')",
        balance="CAST(balance AS DOUBLE)",
    )
    + " FROM raw_customer",
)
def c02(spark, d):
    columns = ["first_name", "email", "zip_code", "nation"]
    return op.impute_nulls(_raw(spark, d), columns, "constant", "Not Available")


NUMBERS = ["zip_code", "balance", "nation"]


def _filled_sql(zip_code: str, balance: str, nation: str) -> str:
    return (
        "SELECT "
        + replaced(
            "raw_customer",
            zip_code=f"coalesce(zip_code, (SELECT {zip_code} FROM raw_customer))",
            balance="CAST(coalesce(balance, "
            f"(SELECT {balance} FROM raw_customer)) AS DOUBLE)",
            nation=f"coalesce(nation, (SELECT {nation} FROM raw_customer))",
        )
        + " FROM raw_customer"
    )


MEAN_SQL = _filled_sql(
    "sum(zip_code) / count(zip_code)",
    "CAST(round(CAST(sum(balance) AS DOUBLE) / count(balance), 2) AS DECIMAL(12,2))",
    "CAST(trunc(avg(nation)) AS INT)",
)


@query("c03_impute_nulls_mean", MEAN_SQL)
def c03(spark, d):
    return op.impute_nulls(_raw(spark, d), NUMBERS, "mean")


@query(
    "c04_impute_nulls_median_exact",
    _filled_sql(*[f"quantile_disc({c}, 0.5)" for c in NUMBERS]),
)
def c04(spark, d):
    return op.impute_nulls(_raw(spark, d), NUMBERS, "median", exact=True)


@query(
    "c04b_impute_nulls_median_bound",
    """SELECT count(*) AS filled_rows, true AS within_bound FROM raw_customer
    WHERE balance IS NULL""",
)
def c04b(spark, d):
    """The approximate fill lies within 0.01 of the middle rank."""
    raw = _raw(spark, d).withColumn("is_filled", F.col("balance").isNull())
    filled = op.impute_nulls(raw, ["balance"], "median")
    fill = F.max(F.when(F.col("is_filled"), F.col("balance")))
    marked = filled.agg(fill.alias("fill"), F.count_if("is_filled").alias("filled_rows"))
    known = raw.where(~F.col("is_filled"))
    fill_value = marked.select("fill").scalar()
    ranks = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("balance") < fill_value).alias("below"),
        F.count_if(F.col("balance") <= fill_value).alias("upto"),
    )
    ok = (F.col("below") <= F.col("n") * 0.51) & (F.col("upto") >= F.col("n") * 0.49)
    return ranks.select(
        marked.select("filled_rows").scalar().alias("filled_rows"),
        ok.alias("within_bound"),
    )


def _mode_sql(column: str) -> str:
    return f"""(SELECT {column} FROM raw_customer WHERE {column} IS NOT NULL
        GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"""


@query(
    "c05_impute_nulls_mode",
    "SELECT "
    + replaced(
        "raw_customer",
        nation=f"coalesce(nation, {_mode_sql('nation')})",
        phone_number=f"coalesce(phone_number, {_mode_sql('phone_number')})",
        birth_date=f"coalesce(birth_date, {_mode_sql('birth_date')})",
        balance="CAST(balance AS DOUBLE)",
    )
    + " FROM raw_customer",
)
def c05(spark, d):
    columns = ["nation", "phone_number", "birth_date"]
    return op.impute_nulls(_raw(spark, d), columns, "mode")


DOCUMENT_COLUMNS = ["lang", "source", "n_chars", "text"]


def _document_mode_sql(column: str) -> str:
    return _mode_sql(column).replace("raw_customer", "raw_document")


@query(
    "c05b_impute_nulls_mode_by_digest",
    "SELECT doc_id, "
    + ", ".join(
        f"coalesce({c}, {_document_mode_sql(c)}) AS {c}" for c in DOCUMENT_COLUMNS[:3]
    )
    + f", md5(coalesce(text, {_document_mode_sql('text')})) AS text_md5 FROM raw_document",
)
def c05b(spark, d):
    """Few and many, short and long values: frequent ones by sketch, the rest by digest."""
    raw = view(spark, d, "raw_document")
    filled = op.impute_nulls(raw, DOCUMENT_COLUMNS, "mode", exact=True)
    return filled.select("doc_id", *DOCUMENT_COLUMNS[:3], F.md5("text").alias("text_md5"))


@query("c07_impute_missing_values_mean", MEAN_SQL)
def c07(spark, d):
    return op.impute_missing_values(_raw(spark, d))


@query(
    "c07b_impute_missing_values_value",
    "SELECT "
    + replaced(
        "raw_customer",
        zip_code="coalesce(zip_code, 7)",
        balance="CAST(coalesce(balance, 7) AS DOUBLE)",
        nation="coalesce(nation, 7)",
        first_name="coalesce(first_name, '7')",
        email="coalesce(email, '7')",
        phone_number="coalesce(phone_number, '7')",
        birth_date="coalesce(birth_date, '7')",
    )
    + " FROM raw_customer",
)
def c07b(spark, d):
    return op.impute_missing_values(_raw(spark, d), "value", 7)


TEXTS = ("first_name", "last_name", "email", "phone_number", "birth_date")
BLANKED = "SELECT " + replaced(
    "raw_customer",
    balance="CAST(balance AS DOUBLE)",
    **{
        c: f"CASE WHEN {c} IN ('null', 'None', '') THEN NULL ELSE {c} END"
        for c in TEXTS
    },
)
REQUIRED = ["first_name", "last_name", "zip_code"]


@query(
    "c08_drop_nulls",
    f"""SELECT * FROM ({BLANKED} FROM raw_customer)
    WHERE first_name IS NOT NULL AND last_name IS NOT NULL AND zip_code IS NOT NULL""",
)
def c08(spark, d):
    return op.drop_nulls(_raw(spark, d), REQUIRED)


@query(
    "k01_rejected_rows",
    f"""SELECT * FROM ({BLANKED} FROM raw_customer)
    WHERE first_name IS NULL OR last_name IS NULL OR zip_code IS NULL""",
)
def k01(spark, d):
    return op.split_nulls(_raw(spark, d), REQUIRED)[1]


@query(
    "c08b_drop_nulls_any_column",
    f"SELECT * FROM ({BLANKED} FROM raw_customer) WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in columns_of("raw_customer")),
)
def c08b(spark, d):
    return op.drop_nulls(_raw(spark, d))


@query(
    "c20_total_null_count",
    "SELECT CAST(sum("
    + " + ".join(
        f"CASE WHEN {c} IS NULL OR CAST({c} AS VARCHAR) = 'null' THEN 1 ELSE 0 END"
        for c in columns_of("raw_customer")
    )
    + ") AS BIGINT) AS total_null_count FROM raw_customer",
)
def c20(spark, d):
    return op.total_null_count(_raw(spark, d))


# Formats --------------------------------------------------------------------


@query(
    "c09_remove_decimal",
    """SELECT c_custkey, CAST(floor(c_acctbal) AS BIGINT) AS c_acctbal,
    CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""",
)
def c09(spark, d):
    customers = table(spark, d, "customer")
    floored = op.remove_decimal(customers, ["c_acctbal", "c_nationkey"])
    return floored.select("c_custkey", "c_acctbal", "c_nationkey")


DATE_SQL = """coalesce(strftime(coalesce(try_strptime({c}, '%d.%m.%Y'),
    try_strptime({c}, '%d/%m/%Y'), try_strptime({c}, '%d/%b/%Y'),
    try_strptime({c}, '%d.%B.%Y'), try_strptime({c}, '%Y-%m-%d'),
    try_strptime({c}, '%m/%d/%Y'), try_strptime({c}, '%d-%b-%Y')), '%Y-%m-%d'),
    'Invalid Date')"""


@query(
    "c10_standardize_date_format",
    f"SELECT customer_id, {DATE_SQL.format(c='birth_date')} AS birth_date "
    "FROM raw_customer",
)
def c10(spark, d):
    dated = op.standardize_date_format(_raw(spark, d), "birth_date")
    return dated.select("customer_id", "birth_date")


DIALLED = "regexp_replace({c}, '[^0-9Xx]', '', 'g')"
PHONE_SQL = """CASE WHEN {c} = 'Not Available' THEN {c}
    WHEN regexp_matches({n}, '^[0-9]{{10}}([Xx][0-9]+)?$')
    THEN '+1 (' || {n}[1:3] || ') ' || {n}[4:6] || '-' || replace({n}[7:], 'X', 'x')
    WHEN regexp_matches({n}, '^1[0-9]{{10}}([Xx][0-9]+)?$')
    THEN '+1 (' || {n}[2:4] || ') ' || {n}[5:7] || '-' || replace({n}[8:], 'X', 'x')
    WHEN regexp_matches({n}, '^001[0-9]{{9}}([Xx][0-9]+)?$')
    THEN '+1 (' || {n}[4:6] || ') ' || {n}[7:9] || '-' || replace({n}[10:], 'X', 'x')
    ELSE 'Invalid phone number' END""".replace("{n}", DIALLED)


@query(
    "c11_clean_phone_numbers",
    f"SELECT customer_id, {PHONE_SQL.format(c='phone_number')} AS phone_number "
    "FROM raw_customer",
)
def c11(spark, d):
    cleaned = op.clean_phone_numbers(_raw(spark, d), "phone_number")
    return cleaned.select("customer_id", "phone_number")


EMAIL_SQL = """CASE WHEN regexp_matches({c}, '^[^@]+@[^@]+\\.[^@]+$') THEN {c}
    ELSE 'Invalid Email' END"""


@query(
    "c19_validate_emails",
    f"SELECT customer_id, {EMAIL_SQL.format(c='email')} AS email FROM raw_customer",
)
def c19(spark, d):
    checked = op.validate_emails(_raw(spark, d), "email", "Invalid Email")
    return checked.select("customer_id", "email")


@query(
    "c18_remove_string_from_columns",
    r"""SELECT doc_id, regexp_replace(text, '\n', '', 'g') AS text,
    regexp_replace(source, '\n', '', 'g') AS source FROM documents""",
)
def c18(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text", "source")
    return op.remove_string_from_columns(documents, ["text", "source"], r"\n")


@query(
    "c18b_remove_literal_string",
    "SELECT doc_id, replace(text, '. ', '') AS text FROM documents",
)
def c18b(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    return op.remove_string_from_columns(documents, ["text"], ". ", literal=True)


@query(
    "c21_convert_column_type",
    """SELECT CAST(customer_id AS BIGINT) AS customer_id,
    CAST(CAST(nation AS BIGINT) AS VARCHAR) AS nation,
    TRY_CAST(birth_date AS DATE) AS birth_date FROM
    (SELECT floor(customer_id) AS customer_id, nation, CASE WHEN birth_date LIKE '19%'
    THEN birth_date END AS birth_date FROM raw_customer)""",
)
def c21(spark, d):
    df = _raw(spark, d).select("customer_id", "nation", "birth_date")
    for column, target in [
        ("customer_id", "long"),
        ("nation", "string"),
        ("birth_date", "date"),
    ]:
        df = op.convert_column_type(df, column, target)
    return df


# Negative values ------------------------------------------------------------


def _negatives(spark: SparkSession, d: str, operation: str, **options) -> DataFrame:
    raw = _raw(spark, d).select("customer_id", "zip_code", "balance")
    return op.handle_negative_values(raw, ["zip_code", "balance"], operation, **options)


def _negatives_sql(rule: str, where: str = "") -> str:
    return f"""SELECT customer_id, {rule.format(c='zip_code')} AS zip_code,
    CAST({rule.format(c='balance')} AS DOUBLE) AS balance FROM raw_customer {where}"""


@query("c12_negatives_absolute", _negatives_sql("abs({c})"))
def c12(spark, d):
    return _negatives(spark, d, "absolute")


@query(
    "c13_negatives_remove", _negatives_sql("CASE WHEN {c} >= 0 THEN {c} END")
)
def c13(spark, d):
    return _negatives(spark, d, "remove")


@query(
    "c14_negatives_zero", _negatives_sql("CASE WHEN {c} >= 0 THEN {c} ELSE 0 END")
)
def c14(spark, d):
    return _negatives(spark, d, "zero")


@query(
    "c15_negatives_drop",
    _negatives_sql("{c}", "WHERE zip_code >= 0 AND balance >= 0"),
)
def c15(spark, d):
    return _negatives(spark, d, "drop")


@query(
    "c16_negatives_floor",
    """SELECT customer_id, CAST(floor(abs(zip_code)) AS BIGINT) AS zip_code,
    CAST(floor(abs(balance)) AS DOUBLE) AS balance FROM raw_customer""",
)
def c16(spark, d):
    return _negatives(spark, d, "absolute", apply_floor=True)


# Enrichment -----------------------------------------------------------------


@query(
    "t01_add_age_column",
    f"""SELECT customer_id, birth_date, CAST(floor(date_diff('day', birth_date,
    DATE '{AS_OF}') / CAST(365.25 AS DOUBLE)) AS BIGINT) AS age FROM shop_customer""",
)
def t01(spark, d):
    customers = view(spark, d, "shop_customer").select("customer_id", "birth_date")
    return op.add_age_column(customers, "birth_date", as_of=AS_OF)


STATES = (
    "('AL','AK','AZ','AR','CA','CO','CT','DE','FL','GA','HI','ID','IL','IN','IA','KS',"
    "'KY','LA','ME','MD','MA','MI','MN','MS','MO','MT','NE','NV','NH','NJ','NM','NY',"
    "'NC','ND','OH','OK','OR','PA','RI','SC','SD','TN','TX','UT','VT','VA','WA','WV',"
    "'WI','WY')"
)
STATE_SQL = (
    r"CASE WHEN regexp_extract({c}, '\b([A-Z]{{2}})\b', 1) IN "
    + STATES
    + r" THEN regexp_extract({c}, '\b([A-Z]{{2}})\b', 1) ELSE 'Not Available' END"
)


@query(
    "t02_add_state_columns",
    f"""SELECT order_id, {STATE_SQL.format(c='shipping_address')} AS shipping_state,
    {STATE_SQL.format(c='billing_address')} AS billing_state FROM shop_orders""",
)
def t02(spark, d):
    stated = op.add_state_columns(
        view(spark, d, "shop_orders"), "shipping_address", "billing_address"
    )
    return stated.select("order_id", "shipping_state", "billing_state")


@query(
    "t02b_add_state_columns_any",
    f"""SELECT order_id, {STATE_SQL.format(c='shipping_address')} AS shipping_state,
    CASE WHEN billing_address IS NULL THEN 'Not Available' ELSE 'NV' END
    AS billing_state FROM shop_orders""",
)
def t02b(spark, d):
    stated = op.add_state_columns(
        view(spark, d, "shop_orders"), "shipping_address", "billing_address", mode="any"
    )
    return stated.select("order_id", "shipping_state", "billing_state")


# Chains ---------------------------------------------------------------------

# Steps, messages and columns of the configuration that is checked.
FILL = {"method": "constant", "value": "Not Available"}

CLEANING = {
    "customer": {
        "remove_duplicates": {"columns": ["customer_id"]},
        "remove_decimal": {"columns": ["customer_id", "zip_code"]},
        "handle_negative_values": {"columns": ["zip_code"], "operation": "absolute"},
        "validate_emails": {"column": "email", "invalid_message": "Invalid Email"},
        "clean_phone_numbers": {"column": "phone_number"},
        "standardize_date_format": {"column": "birth_date"},
        "impute_nulls": {"columns": ["first_name", "zip_code"], **FILL},
        "drop_nulls": {"columns": ["customer_id", "last_name"]},
        "convert_column_type": [
            {"column": "customer_id", "target_type": "long"},
            {"column": "zip_code", "target_type": "string"},
            {"column": "birth_date", "target_type": "date"},
        ],
    },
    "orders": {
        "remove_duplicates": {"columns": ["order_id"]},
        "remove_decimal": {"columns": ["order_id", "customer_id", "total_amount"]},
        "handle_negative_values": {"columns": ["total_amount"]},
        "impute_nulls": {
            "columns": [
                "customer_id",
                "total_amount",
                "shipping_address",
                "billing_address",
            ],
            **FILL,
        },
        "drop_nulls": {"columns": ["order_id"]},
        "standardize_date_format": {"column": "order_date"},
        "remove_string_from_columns": {
            "columns": ["shipping_address", "billing_address"],
            "string_to_remove": "\\n",
        },
        "convert_column_type": [
            {"column": "order_id", "target_type": "long"},
            {"column": "customer_id", "target_type": "long"},
            {"column": "order_date", "target_type": "date"},
        ],
    },
    "product": {
        "remove_duplicates": {"columns": ["product_id"]},
        "remove_decimal": {"columns": ["product_id", "inventory"]},
        "handle_negative_values": {"columns": ["product_id", "price", "inventory"]},
        "impute_nulls": {"columns": ["product_name", "category", "description"], **FILL},
        "drop_nulls": {"columns": ["product_id"]},
        "remove_string_from_columns": {
            "columns": ["description"],
            "string_to_remove": "\\n",
        },
        "convert_column_type": [
            {"column": "product_id", "target_type": "long"},
            {"column": "inventory", "target_type": "int"},
        ],
    },
    "order_item": {
        "remove_duplicates": {"columns": ["order_item_id"]},
        "handle_negative_values": {
            "columns": ["order_item_id", "order_id", "product_id", "quantity", "price"]
        },
        "impute_nulls": {"columns": ["order_id", "product_id", "quantity"], **FILL},
        "drop_nulls": {"columns": ["order_item_id"]},
    },
    "review": {
        "remove_duplicates": {"columns": ["review_id"]},
        "handle_negative_values": {
            "columns": ["review_id", "product_id", "customer_id", "rating"]
        },
        "impute_nulls": {
            "columns": ["product_id", "customer_id", "rating", "review_text"],
            **FILL,
        },
        "drop_nulls": {"columns": ["review_id"]},
        "remove_string_from_columns": {
            "columns": ["review_text"],
            "string_to_remove": "\\n",
        },
        "standardize_date_format": {"column": "review_date"},
        "convert_column_type": {"column": "review_date", "target_type": "date"},
    },
}

TRANSFORMS = {
    "customer": {"add_age_column": {"birth_date_column": "birth_date", "as_of": AS_OF}},
    "orders": {
        "add_state_columns": {
            "shipping_col": "shipping_address",
            "billing_col": "billing_address",
        }
    },
}


# The view of each raw table, and the column in which its repeated rows differ. Keys
# of order items repeat by themselves.
RAW_VIEWS = {
    "customer": ("raw_customer", "first_name"),
    "orders": ("raw_order", "shipping_address"),
    "product": ("raw_product", "product_name"),
    "order_item": ("raw_order_item", None),
    "review": ("raw_review", "review_text"),
}


def raw_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Raw rows, each once more under the same key."""
    source, column = RAW_VIEWS[name]
    raw = view(spark, d, source)
    return raw.unionByName(raw.withColumn(column, F.lit("Zed"))) if column else raw


def raw_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {name: raw_table(spark, d, name) for name in CLEANING}


def cleaned(spark: SparkSession, d: str, name: str) -> DataFrame:
    return run_cleaning({name: raw_table(spark, d, name)}, CLEANING).tables[name]


def repeated_sql(name: str) -> str:
    source, column = RAW_VIEWS[name]
    again = replaced(source, **{column: "'Zed'"})
    return f"(SELECT * FROM {source} UNION ALL SELECT {again} FROM {source})"


def first_by_key(source: str, view_name: str, key: str) -> str:
    """The smallest row per key, by the other columns from left to right."""
    others = [c for c in columns_of(view_name) if c != key]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in others)
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}
        ORDER BY {order}) AS place FROM {source}) WHERE place = 1)"""


BLANK = "CASE WHEN {c} IN ('null', 'None', '') THEN NULL ELSE {c} END"

CUSTOMER_SQL = f"""SELECT CAST(floor(customer_id) AS BIGINT) AS customer_id,
    {BLANK.format(c="coalesce(nullif(first_name, 'null'), 'Not Available')")}
    AS first_name, last_name, {EMAIL_SQL.format(c='email')} AS email,
    {PHONE_SQL.format(c='phone_number')} AS phone_number,
    TRY_CAST({DATE_SQL.format(c='birth_date')} AS DATE) AS birth_date,
    CAST(CAST(abs(floor(zip_code)) AS BIGINT) AS VARCHAR) AS zip_code,
    CAST(balance AS DOUBLE) AS balance, nation
    FROM {first_by_key(repeated_sql('customer'), 'raw_customer', 'customer_id')}
    WHERE last_name NOT IN ('null', 'None', '')"""


@query("c23_clean_customers", CUSTOMER_SQL)
def c23_customers(spark, d):
    return cleaned(spark, d, "customer")


def _address(column: str) -> str:
    filled = f"coalesce(nullif({column}, 'null'), 'Not Available')"
    return f"replace({filled}, chr(10), '')"


ORDERS_SQL = f"""SELECT CAST(floor(order_id) AS BIGINT) AS order_id,
    CAST(floor(customer_id) AS BIGINT) AS customer_id,
    TRY_CAST({DATE_SQL.format(c='order_date')} AS DATE) AS order_date,
    CAST(abs(floor(total_amount)) AS BIGINT) AS total_amount,
    {_address('shipping_address')} AS shipping_address,
    {_address('billing_address')} AS billing_address
    FROM {first_by_key(repeated_sql('orders'), 'raw_order', 'order_id')}"""


@query("c23_clean_orders", ORDERS_SQL)
def c23_orders(spark, d):
    return cleaned(spark, d, "orders")


@query(
    "c23_clean_products",
    f"""SELECT CAST(abs(floor(product_id)) AS BIGINT) AS product_id,
    coalesce(nullif(product_name, 'null'), 'Not Available') AS product_name,
    coalesce(category, 'Not Available') AS category,
    replace(coalesce(nullif(description, 'null'), 'Not Available'), chr(10), '')
    AS description, abs(price) AS price, CAST(abs(floor(inventory)) AS INT) AS inventory
    FROM {first_by_key(repeated_sql('product'), 'raw_product', 'product_id')}""",
)
def c23_products(spark, d):
    return cleaned(spark, d, "product")


@query(
    "c23_clean_order_items",
    f"""SELECT abs(order_item_id) AS order_item_id, abs(order_id) AS order_id,
    abs(product_id) AS product_id, abs(quantity) AS quantity, abs(price) AS price
    FROM {first_by_key('raw_order_item', 'raw_order_item', 'order_item_id')}""",
)
def c23_order_items(spark, d):
    return cleaned(spark, d, "order_item")


@query(
    "c23_clean_reviews",
    f"""SELECT abs(review_id) AS review_id, abs(product_id) AS product_id,
    abs(customer_id) AS customer_id, CAST(abs(rating) AS BIGINT) AS rating,
    replace(coalesce(nullif(review_text, 'null'), 'Not Available'), chr(10), '')
    AS review_text, TRY_CAST({DATE_SQL.format(c='review_date')} AS DATE) AS review_date
    FROM {first_by_key(repeated_sql('review'), 'raw_review', 'review_id')}
    WHERE review_id IS NOT NULL""",
)
def c23_reviews(spark, d):
    return cleaned(spark, d, "review")


@query(
    "t04_enrich_customers",
    f"""SELECT *, CAST(floor(date_diff('day', birth_date, DATE '{AS_OF}')
    / CAST(365.25 AS DOUBLE)) AS BIGINT) AS age FROM ({CUSTOMER_SQL})""",
)
def t04_customers(spark, d):
    return run_transforms({"customer": cleaned(spark, d, "customer")}, TRANSFORMS)[
        "customer"
    ]


@query(
    "t04_enrich_orders",
    f"""SELECT *, {STATE_SQL.format(c='shipping_address')} AS shipping_state,
    {STATE_SQL.format(c='billing_address')} AS billing_state FROM ({ORDERS_SQL})""",
)
def t04_orders(spark, d):
    return run_transforms({"orders": cleaned(spark, d, "orders")}, TRANSFORMS)["orders"]


@query(
    "e2e_clean_enrich_top_products",
    f"""WITH cleaned AS ({CUSTOMER_SQL}),
    aged AS (SELECT customer_id, CAST(floor(date_diff('day', birth_date,
        DATE '{AS_OF}') / CAST(365.25 AS DOUBLE)) AS BIGINT) AS age FROM cleaned),
    sold AS (SELECT {analytics.BAND} AS age_group, i.product_id,
        CAST(sum(i.quantity) AS BIGINT) AS total_quantity
        FROM aged c JOIN shop_orders o ON c.customer_id = o.customer_id
        JOIN shop_order_item i ON i.order_id = o.order_id GROUP BY ALL),
    ranked AS (SELECT *, CAST(rank() OVER (PARTITION BY age_group
        ORDER BY total_quantity DESC) AS INT) AS rank FROM sold)
    SELECT r.age_group, r.product_id, p.product_name, r.total_quantity, r.rank
    FROM ranked r JOIN shop_product p ON r.product_id = p.product_id
    WHERE r.rank <= 5""",
)
def flagship(spark, d):
    """Clean raw customers, add their age, rank the products of each age band."""
    return op.top_products_by_age_group(
        t04_customers(spark, d),
        view(spark, d, "shop_orders"),
        view(spark, d, "shop_order_item"),
        view(spark, d, "shop_product"),
    )
