
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import query_inputs as extracts
from sluice import session
from sluice.functions.contract import Contract
from sluice.functions.parsing import NULL_TOKENS
from sluice.operators import profile, rowindex
from sluice.plans.jobs import IngestConfig, ingest, month_job
from sluice.sinks import tables
from sluice.sources import literals
from sluice.sources.delimited import read_delimited
from sluice.sources.files import file_inventory
from sluice.sources.months import read_months
from sluice.streaming import chunk_load

ORDERS = Contract.of(
    {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderpriority": "string",
    },
    ["o_orderdate"],
)
EVENTS = Contract.of({"event_id": "bigint", "user_id": "bigint", "value": "double"}, ["ts"])
DOCUMENTS = Contract.of({"doc_id": "bigint", "n_chars": "bigint"})
MONTH_FOLDER = "/ym={year}-{month:02d}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- inputs, written from the tables ---------------------------------------------------------


def orders_csv(spark: SparkSession, sf_dir: str, gzip: bool = False) -> str:
    orders = table(spark, sf_dir, "orders")
    label = "orders-gz" if gzip else "orders"
    return extracts.kept(
        spark, sf_dir, label, lambda folder: extracts.write_sorted(orders, folder, "o_orderkey", gzip=gzip)
    )


def orders_months(spark: SparkSession, sf_dir: str) -> str:
    orders = table(spark, sf_dir, "orders")
    return extracts.kept(
        spark, sf_dir, "order-months",
        lambda folder: extracts.write_months(orders, folder, "o_orderdate", "o_orderkey"),
    )


def order_month_range(spark: SparkSession, sf_dir: str) -> tuple[tuple[int, int], tuple[int, int]]:
    ends = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    return (ends.a.year, ends.a.month), (ends.b.year, ends.b.month)


def events_csv(spark: SparkSession, sf_dir: str) -> str:
    events = table(spark, sf_dir, "events")
    return extracts.kept(spark, sf_dir, "events", lambda folder: extracts.write_sorted(events, folder, "event_id"))


def page_files(spark: SparkSession, sf_dir: str) -> str:
    pages = table(spark, sf_dir, "pages").withColumn("name", F.format_string("page_%d.html", "page_id"))
    return extracts.kept(
        spark, sf_dir, "pages", lambda folder: extracts.write_named_files(pages, folder, "name", "html")
    )


def indexed(spark: SparkSession, folder: str, contract: Contract) -> DataFrame:
    """All parts of a folder as one source, numbered in path order."""
    return rowindex.read_indexed(spark, folder, contract, {}, headers="first")


def new_table() -> str:
    return f"t_{uuid.uuid4().hex}"


def loaded_orders(spark: SparkSession, sf_dir: str) -> str:
    """Name of a table that was loaded twice, each load replacing what was there."""
    name, folder = new_table(), session.fresh_dir(spark, "tables")
    for _ in range(2):
        tables.replace_table(indexed(spark, orders_csv(spark, sf_dir), ORDERS), name, folder)
    return name


# --- queries ---------------------------------------------------------------------------------


def read_typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_delimited(spark, orders_csv(spark, sf_dir, gzip=True), ORDERS)


def read_plain_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_delimited(spark, orders_csv(spark, sf_dir), ORDERS, headers="first")


def read_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    folder = extracts.kept(
        spark, sf_dir, "documents", lambda path: extracts.write_csv(documents, path, gzip=True)
    )
    return read_delimited(spark, folder, DOCUMENTS)


def read_quoted_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    folder = extracts.kept(spark, sf_dir, "documents-plain", lambda path: extracts.write_csv(documents, path))
    return read_delimited(spark, folder, DOCUMENTS)


def read_header_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    final = F.col("o_orderstatus") == "F"
    one = extracts.kept(
        spark, sf_dir, "header-a", lambda folder: extracts.write_csv(orders.where(final), folder)
    )
    two = extracts.kept(
        spark, sf_dir, "header-b",
        lambda folder: extracts.write_csv(orders.where(~final).select(*reversed(orders.columns)), folder),
    )
    return read_delimited(spark, [one, two], ORDERS)


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three forms of ISO 8601, each found in its column, and a declared pattern."""
    events = table(spark, sf_dir, "events")
    texts = events.select(
        *[c for c in events.columns if c != "ts"],
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("with_t"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss.SSSSSS").alias("day_first"),
    )
    folder = extracts.kept(spark, sf_dir, "timestamps", lambda path: extracts.write_csv(texts, path))
    contract = Contract.of(EVENTS.types, {"ts": None, "with_t": None, "day": None, "day_first": "dd/MM/yyyy HH:mm:ss.SSSSSS"})
    return read_delimited(spark, folder, contract)


def read_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = F.array(*[F.lit(t) for t in NULL_TOKENS])
    which = (F.col("o_orderkey") % 20).cast("int")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(which == 19, F.col("o_orderstatus")).otherwise(F.get(texts, which)).alias("o_orderstatus"),
        F.when(which == 19, F.col("o_custkey").cast("string")).otherwise(F.get(texts, which)).alias("o_custkey"),
        F.when(which == 19, F.col("o_totalprice").cast("string")).otherwise(F.get(texts, which)).alias("o_totalprice"),
    )
    folder = extracts.kept(spark, sf_dir, "null-tokens", lambda path: extracts.write_csv(orders, path))
    return read_delimited(spark, folder, Contract.of(ORDERS.types))


def parse_integral_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    custkey = F.col("o_custkey").cast("string")
    text = (
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(custkey, F.lit(".0")))
        .when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("+"), custkey))
        .when(F.col("o_orderkey") % 4 == 2, F.concat(custkey, F.lit("e0")))
        .when(F.col("o_orderkey") % 8 == 3, F.concat(custkey, F.lit("000e-3")))
        .otherwise(custkey)
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("o_custkey"))
    folder = extracts.kept(spark, sf_dir, "integral", lambda path: extracts.write_csv(orders, path))
    return read_delimited(spark, folder, Contract.of({"o_orderkey": "bigint", "o_custkey": "bigint"}))


def read_short_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = F.col("o_orderkey") % 10 == 0
    last = F.when(~short, F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders").select(
        F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", last).alias("line")
    )
    names = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    folder = extracts.kept(spark, sf_dir, "short-rows", lambda path: extracts.write_lines(orders, path, names, "line"))
    return read_delimited(spark, folder, Contract.of({"o_orderkey": "bigint"}))


def read_monthly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = order_month_range(spark, sf_dir)
    template = orders_months(spark, sf_dir) + MONTH_FOLDER
    return read_months(spark, template, first, last, contract=ORDERS, headers="first")


def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexed(spark, orders_csv(spark, sf_dir), ORDERS).select("index", "o_orderkey")


def chunk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rowindex.chunk_counts(indexed(spark, orders_csv(spark, sf_dir), ORDERS), 4000)


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, folder = new_table(), session.fresh_dir(spark, "tables")
    tables.replace_table(indexed(spark, orders_csv(spark, sf_dir), ORDERS), name, folder)
    return rowindex.head(spark.table(name)).drop("index")


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_count(table(spark, sf_dir, "lineitem"))


def files_with_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_inventory(spark, page_files(spark, sf_dir))


def file_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_inventory(spark, page_files(spark, sf_dir), exclude="page_0.html", contents=False).select("name", "is_file", "size")


def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = literals.literal_frame(spark, {"day": [1, 2], "num_passengers": [3, 4]})
    orders = table(spark, sf_dir, "orders").select(F.dayofmonth("o_orderdate").cast("bigint").alias("day"))
    per_day = orders.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return per_day.join(frame, "day", "left").select("day", "num_passengers", "n")


def with_literal_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return literals.with_constant(table(spark, sf_dir, "events"), "month", 1)


def write_month_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = (
        table(spark, sf_dir, "orders")
        .groupBy(F.dayofmonth("o_orderdate").cast("bigint").alias("day"))
        .agg(F.count(F.lit(1)).alias("num_passengers"))
    )
    return spark.read.parquet(month_job(spark, "01", session.fresh_dir(spark, "month"), per_day))


def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_types(read_plain_csv(spark, sf_dir))


def table_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    ddl = profile.table_ddl(read_plain_csv(spark, sf_dir), "orders")
    return spark.createDataFrame([(ddl,)], "ddl string")


MEASURES = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
]


def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.describe_numeric(table(spark, sf_dir, "lineitem"), MEASURES)
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "std", "p25", "p50", "p75")]
    return found.select("column_name", "n", "min", "max", *rounded)


def describe_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = profile.describe_timestamp(table(spark, sf_dir, "lineitem"))
    return shipped.unionByName(profile.describe_timestamp(table(spark, sf_dir, "events")))


def load_schema_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, folder = new_table(), session.fresh_dir(spark, "tables")
    rows = read_plain_csv(spark, sf_dir)
    tables.replace_table(rows, name, folder)
    tables.replace_table(rows.limit(0), name, folder)
    emptied = spark.table(name)
    return emptied.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(emptied.columns)).cast("bigint").alias("n_cols"))


def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(loaded_orders(spark, sf_dir))


def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, folder = new_table(), session.fresh_dir(spark, "tables")
    rows = indexed(spark, events_csv(spark, sf_dir), EVENTS)
    tables.replace_table(rows, name, folder)
    tables.append_table(rows, name)
    return spark.table(name)


def stream(spark: SparkSession, sf_dir: str) -> chunk_load.StreamLoad:
    work = session.fresh_dir(spark, "stream")
    load = chunk_load.StreamLoad(
        source=orders_months(spark, sf_dir),
        contract=ORDERS,
        target=f"{work}/rows",
        audit=f"{work}/audit",
        checkpoint=f"{work}/checkpoint",
        max_files=40,
    )
    chunk_load.start(spark, load).awaitTermination()
    return load


def stream_chunk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [*ORDERS.types, *ORDERS.timestamps]
    return spark.read.parquet(stream(spark, sf_dir).target).select(*names)


def stream_chunk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ym = F.regexp_extract("source_file", r"ym=(\d{4}-\d{2})", 1)
    audit = spark.read.parquet(stream(spark, sf_dir).audit).withColumn("ym", ym)
    return audit.groupBy("ym").agg(F.sum("inserted").alias("inserted"))


def ingest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = order_month_range(spark, sf_dir)
    cfg = IngestConfig(
        source=orders_months(spark, sf_dir) + MONTH_FOLDER,
        year=first[0],
        month=first[1],
        last=last,
        target_table=new_table(),
        target_dir=session.fresh_dir(spark, "tables"),
        chunk_size=50,
        contract=ORDERS,
        headers="first",
    )
    return ingest(spark, cfg).chunks


def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = loaded_orders(spark, sf_dir)
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {name} GROUP BY o_orderstatus")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: months of gzipped files, read typed, indexed, loaded, and counted per chunk."""
    return ingest_job(spark, "/root/testdata/sf0.001")


def training_data() -> list:
    """Modules that add queries for training data: the pipeline and the operators, where they are installed."""
    try:
        import corpus_pipeline
        import sluice.llm.queries
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "sluice.llm", "sluice.llm.queries"):
            raise
        return []
    return [sluice.llm.queries, corpus_pipeline]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return own_queries() | {name: query for module in training_data() for name, query in module.queries().items()}


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ingest_job": ingest_job,
        "read_typed_csv": read_typed_csv,
        "read_plain_csv": read_plain_csv,
        "read_quoted_text": read_quoted_text,
        "read_quoted_plain": read_quoted_plain,
        "read_header_bound": read_header_bound,
        "parse_timestamps": parse_timestamps,
        "read_null_tokens": read_null_tokens,
        "parse_integral_text": parse_integral_text,
        "read_short_rows": read_short_rows,
        "read_monthly_files": read_monthly_files,
        "row_index": row_index,
        "chunk_audit": chunk_audit,
        "head_rows": head_rows,
        "row_count": row_count,
        "file_inventory": files_with_content,
        "file_exclude": file_exclude,
        "literal_rows": literal_rows,
        "with_literal_column": with_literal_column,
        "write_month_parquet": write_month_parquet,
        "column_types": column_types,
        "table_ddl": table_ddl,
        "describe_numeric": describe_numeric,
        "describe_timestamp": describe_timestamp,
        "load_schema_only": load_schema_only,
        "load_replace": load_replace,
        "load_append": load_append,
        "stream_chunk_load": stream_chunk_load,
        "stream_chunk_audit": stream_chunk_audit,
        "adhoc_sql": adhoc_sql,
    }


# --- the same in SQL -------------------------------------------------------------------------

DESCRIBE_NUMBER = """
SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 4)::DOUBLE AS p25,
       round(quantile_cont({c}, 0.5), 4)::DOUBLE AS p50, round(quantile_cont({c}, 0.75), 4)::DOUBLE AS p75,
       max({c})::DOUBLE AS max
FROM lineitem"""

DESCRIBE_TIME = """
SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, min({c}) AS min,
       quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75,
       max({c}) AS max
FROM {t}"""


def oracle_sql() -> dict[str, str]:
    return own_oracle_sql() | {name: sql for module in training_data() for name, sql in module.oracle_sql().items()}


def own_oracle_sql() -> dict[str, str]:
    return {
        "ingest_job": """
            SELECT year, month, (rn - 1) // 50 AS chunk_id, count(*) AS inserted
            FROM (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month,
                         row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate)
                                            ORDER BY o_orderkey) AS rn
                  FROM orders)
            GROUP BY ALL""",
        "read_typed_csv": "SELECT * FROM orders",
        "read_plain_csv": "SELECT * FROM orders",
        "read_quoted_text": "SELECT * FROM documents",
        "read_quoted_plain": "SELECT * FROM documents",
        "read_header_bound": "SELECT * FROM orders",
        "parse_timestamps": "SELECT *, ts AS with_t, date_trunc('day', ts)::TIMESTAMP AS day, ts AS day_first FROM events",
        "read_null_tokens": """
            SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 19 THEN o_orderstatus END AS o_orderstatus,
                   CASE WHEN o_orderkey % 20 = 19 THEN o_custkey END AS o_custkey,
                   CASE WHEN o_orderkey % 20 = 19 THEN o_totalprice END AS o_totalprice
            FROM orders""",
        "parse_integral_text": "SELECT o_orderkey, o_custkey FROM orders",
        "read_short_rows": """
            SELECT o_orderkey, o_orderstatus,
                   CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS o_orderpriority
            FROM orders""",
        "read_monthly_files": """
            SELECT year(o_orderdate) AS year, month(o_orderdate) AS month,
                   row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate)
                                      ORDER BY o_orderkey) - 1 AS "index", *
            FROM orders""",
        "row_index": 'SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS "index", o_orderkey FROM orders',
        "chunk_audit": """
            SELECT (rn - 1) // 4000 AS chunk_id, count(*) AS inserted
            FROM (SELECT row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
            GROUP BY ALL""",
        "head_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
        "row_count": "SELECT count(*) AS n FROM lineitem",
        "file_inventory": """
            SELECT 'page_' || page_id || '.html' AS name, true AS is_file, strlen(html)::BIGINT AS size, html AS content
            FROM pages""",
        "file_exclude": """
            SELECT 'page_' || page_id || '.html' AS name, true AS is_file, strlen(html)::BIGINT AS size
            FROM pages WHERE page_id <> 0""",
        "literal_rows": """
            SELECT o.day, num_passengers, count(*) AS n
            FROM (SELECT day(o_orderdate) AS day FROM orders) o
            LEFT JOIN (VALUES (1::BIGINT, 3::BIGINT), (2, 4)) t(day, num_passengers) ON o.day = t.day
            GROUP BY ALL""",
        "with_literal_column": "SELECT *, 1::BIGINT AS month FROM events",
        "write_month_parquet": """
            SELECT day(o_orderdate) AS day, count(*) AS num_passengers, 1::BIGINT AS month
            FROM orders GROUP BY ALL""",
        "column_types": """
            SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
                   WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE 'string' END AS column_type
            FROM (DESCRIBE orders)""",
        "table_ddl": """
            SELECT chr(10) || 'CREATE TABLE orders (' || chr(10) || chr(9)
                   || string_agg(column_name || ' ' || CASE column_type WHEN 'BIGINT' THEN 'BIGINT'
                        WHEN 'DOUBLE' THEN 'FLOAT(53)' WHEN 'TIMESTAMP' THEN 'TIMESTAMP WITHOUT TIME ZONE'
                        ELSE 'TEXT' END, ', ' || chr(10) || chr(9))
                   || chr(10) || ')' || chr(10) || chr(10) AS ddl
            FROM (DESCRIBE orders)""",
        "describe_numeric": " UNION ALL ".join(DESCRIBE_NUMBER.format(c=c) for c in MEASURES),
        "describe_timestamp": " UNION ALL ".join(
            DESCRIBE_TIME.format(c=c, t=t) for c, t in (("l_shipdate", "lineitem"), ("ts", "events"))
        ),
        "load_schema_only": """
            SELECT (SELECT count(*) FROM orders WHERE false) AS n_rows,
                   (SELECT count(*) FROM (DESCRIBE orders)) AS n_cols""",
        "load_replace": 'SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS "index", * FROM orders',
        "load_append": """
            SELECT n - 1 AS "index", * EXCLUDE (n, range)
            FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS n FROM events), range(2)""",
        "stream_chunk_load": "SELECT * FROM orders",
        "stream_chunk_audit": """
            SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS inserted FROM orders GROUP BY ALL""",
        "adhoc_sql": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    }
