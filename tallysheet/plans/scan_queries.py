"""Scan, mapping and projection queries (O-01..O-06, O-13, O-14, O-17..O-21, O-24, O-26, O-55, O-57).

Queries that exercise a file format land the driver table in a fresh scratch
folder under the session's checkpoint area first, then return the lazy scan
of what was landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.casts import day_text, iso_text, truncate_seconds
from tallysheet.functions.keys import source_key
from tallysheet.operators.mapping import apply_mapping, read_schema, spread_sections
from tallysheet.plans.registry import SOURCE_URL, register
from tallysheet.session import scratch_path
from tallysheet.sinks.documents import write_documents
from tallysheet.sinks.eav import to_eav, write_eav
from tallysheet.sinks.files import write_csv
from tallysheet.sources.csv_typed import read_typed_csv
from tallysheet.sources.documents import parse_documents, read_documents, read_unit_documents, rejected_documents, tag_union
from tallysheet.sources.eav import read_eav
from tallysheet.sources.tables import Tables

# Documents per landed page are bounded by a key range of this width.
PAGE_WIDTH = 500

CUSTOMER_SPEC = {
    "c_custkey": {"column": "custkey", "type": "long"},
    "c_name": {"column": "name", "type": "str"},
    "c_nationkey": {"column": "nationkey", "type": "int"},
    "c_acctbal": {"column": "acctbal", "type": "float"},
}


@register(
    "json_scan",
    "SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer",
)
def q_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _land_customers(Tables(spark, sf_dir).customer, "json_scan")
    # A page cut off in the middle, on top of the whole ones: skipped here, listed by ``rejects``.
    spark.createDataFrame([('{"customers":[{"c_custkey":1,"c_na',)], "value string").write.text(f"{landed}/cut")
    items = read_documents(spark, f"{landed}/*", "customers", read_schema(CUSTOMER_SPEC), on_bad="skip")
    return apply_mapping(items, CUSTOMER_SPEC)


def _land_customers(customer: DataFrame, name: str) -> str:
    """Customer pages in both layouts: every other page is a bare list."""
    landed = scratch_path(customer.sparkSession, name)
    page = F.floor(F.col("c_custkey") / PAGE_WIDTH)
    write_documents(customer.where(page % 2 == 0), f"{landed}/named", "customers", page)
    write_documents(customer.where(page % 2 == 1), f"{landed}/bare", None, page)
    return landed


@register(
    "rejects",
    f"""SELECT count(*) AS documents, count(*) FILTER (WHERE page % 3 = 0) AS rejected,
       CAST(sum(n) FILTER (WHERE page % 3 <> 0) AS BIGINT) AS items
FROM (SELECT CAST(floor(c_custkey / {PAGE_WIDTH}) AS BIGINT) AS page, count(*) AS n FROM customer GROUP BY 1)""",
)
def q_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third page loses its end: it must be listed, and nothing of it may be read."""
    path = scratch_path(spark, "rejects")
    page = F.floor(F.col("c_custkey") / PAGE_WIDTH).alias("page")
    pages = Tables(spark, sf_dir).customer.groupBy(page).agg(F.collect_list(F.struct("c_custkey", "c_name")).alias("items"))
    text = F.when(F.col("page") % 2 == 0, F.to_json(F.struct(F.col("items").alias("customers")))).otherwise(F.to_json("items"))
    cut = F.when(F.col("page") % 3 == 0, F.left(text, F.length(text) - 9)).otherwise(text)
    pages.select(cut.alias("value")).write.text(path)
    schema = read_schema(CUSTOMER_SPEC)
    read = read_documents(spark, path, "customers", schema, on_bad="skip").agg(F.count("c_custkey").alias("items"))
    bad = rejected_documents(spark, path, "customers", schema).agg(F.count("text").alias("rejected"))
    return spark.read.text(path).agg(F.count("value").alias("documents")).select(
        "documents", bad.scalar().alias("rejected"), read.scalar().alias("items"))


DATA_VALUE_ITEM = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)


@register(
    "partitioned_json_scan",
    "SELECT o_orderpriority AS orgunit, o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
)
def q_partitioned_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = scratch_path(spark, "data_values")
    orders = Tables(spark, sf_dir).orders.select(
        F.col("o_orderpriority").alias("orgunit"), "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    # Units of one letter land bare lists, the others named ones.
    page, urgent = F.floor(F.col("o_orderkey") / PAGE_WIDTH), F.col("orgunit").startswith("1")
    write_documents(orders.where(~urgent), landed, "dataValues", page, partition_by=["orgunit"])
    write_documents(orders.where(urgent), landed, None, page, partition_by=["orgunit"], mode="append")
    # A unit whose download came back empty: an empty file, zero rows.
    spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{landed}/orgunit=EMPTYUNIT")
    return read_unit_documents(spark, landed, "dataValues", DATA_VALUE_ITEM, "orgunit", layout="directory")


@register(
    "source_tag_union",
    """SELECT 'formF' AS SOURCE_FORM, o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL BY NAME
SELECT 'formO' AS SOURCE_FORM, o_orderkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
UNION ALL BY NAME
SELECT 'formP' AS SOURCE_FORM, o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""",
)
def q_source_tag_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders
    status = F.col("o_orderstatus")
    frames = {
        "formF": orders.where(status == "F").select("o_orderkey", "o_custkey", "o_totalprice"),
        "formO": orders.where(status == "O").select("o_orderkey", "o_orderdate", "o_orderpriority"),
        "formP": orders.where(status == "P").select("o_orderkey", "o_custkey", "o_orderpriority"),
    }
    return tag_union(frames)


@register(
    "csv_typed_roundtrip",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority FROM orders""",
)
def q_csv_typed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(Tables(spark, sf_dir).orders, path)
    return read_typed_csv(spark, path, {"o_orderkey": "long", "o_totalprice": "float", "o_orderdate": "timestamp"})


@register(
    "eav_roundtrip",
    """SELECT CAST(c_custkey AS VARCHAR) || '-' || CAST(c_nationkey AS VARCHAR) AS pk,
       c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal FROM customer""",
)
def q_eav_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "eav")
    customer = Tables(spark, sf_dir).customer
    write_eav(to_eav(customer, ["c_custkey", "c_nationkey"]), path)
    return read_eav(spark, path, exclude=["c_mktsegment"])


ORDER_SPEC = {
    "o_orderkey": {"column": "uid", "type": "long"},
    "created": {"column": "created", "type": "timestamp"},
    "o_orderpriority": {"column": "priority", "type": "str"},
    "o_totalprice": {"column": "price", "type": "float"},
    "o_custkey": {"column": "customer", "type": "int"},
}


@register(
    "mapping_projection",
    """SELECT o_orderkey AS uid, o_orderdate AS created, o_orderpriority AS priority,
       o_totalprice AS price, CAST(o_custkey AS INTEGER) AS customer FROM orders""",
)
def q_mapping_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders
    # The API form of the row: ISO text timestamps with a zone suffix, numbers as text.
    raw = orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.concat(iso_text(F.col("o_orderdate")), F.lit("+0000")).alias("created"),
        "o_orderpriority",
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
    )
    return apply_mapping(raw, ORDER_SPEC)


EVENT_SPEC = {
    "event_id": {"column": "event_id", "type": "long"},
    "event_type": {"column": "event_type", "type": "str"},
    "props": {"nestedColumns": {"k": {"column": "k", "type": "int"}}},
}


@register(
    "nested_projection",
    "SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def q_nested_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Tables(spark, sf_dir).events
    props_schema = read_schema(EVENT_SPEC)["props"].dataType
    parsed = events.select("event_id", "event_type", F.from_json("props", props_schema).alias("props"))
    return apply_mapping(parsed, EVENT_SPEC)


@register(
    "source_key",
    f"SELECT page_id, md5(url) AS page_key, md5('{SOURCE_URL}') AS sourceid FROM pages",
)
def q_source_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = Tables(spark, sf_dir).pages
    return pages.select("page_id", F.md5("url").alias("page_key"), source_key(SOURCE_URL).alias("sourceid"))


FORM_ITEM = T.StructType(
    [
        T.StructField("s1", T.StructType([T.StructField("o_orderkey", T.LongType())])),
        T.StructField(
            "s2",
            T.StructType([T.StructField("o_custkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())]),
        ),
        T.StructField("s3", T.StructType([T.StructField("o_totalprice", T.DoubleType())])),
        T.StructField("s4", T.StructType([T.StructField("interview_date", T.StringType())])),
        T.StructField(
            "s5",
            T.StructType(
                [T.StructField("o_orderstatus", T.StringType()), T.StructField("o_orderpriority", T.StringType())]
            ),
        ),
        T.StructField("s6", T.StructType([T.StructField("o_orderpriority", T.StringType())])),
        T.StructField("s7", T.StructType([T.StructField("source_year", T.IntegerType())])),
    ]
)
FORM_SECTIONS = ["s1", "s2", "s3", "s4", "s6", "s7", "s5"]


@register(
    "section_spread",
    """SELECT 'orders_form' AS SOURCE_FORM, o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'O' THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS interview_date,
       CASE WHEN o_orderstatus = 'O' THEN o_orderpriority || '!' ELSE o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS source_year
FROM orders""",
)
def q_section_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders
    is_open = F.col("o_orderstatus") == "O"
    item = F.struct(
        F.struct("o_orderkey").alias("s1"),
        F.struct("o_custkey", "o_orderstatus").alias("s2"),
        F.struct("o_totalprice").alias("s3"),
        F.struct(day_text(F.col("o_orderdate")).alias("interview_date")).alias("s4"),
        # Optional section: present only on open orders, and it re-states two fields.
        F.when(
            is_open,
            F.struct(
                F.lower("o_orderstatus").alias("o_orderstatus"),
                F.concat("o_orderpriority", F.lit("!")).alias("o_orderpriority"),
            ),
        ).alias("s5"),
        F.struct("o_orderpriority").alias("s6"),
        F.struct(F.year("o_orderdate").alias("source_year")).alias("s7"),
    )
    # One response body per page of forms, as it comes off the wire.
    bodies = orders.groupBy(F.floor(F.col("o_orderkey") / PAGE_WIDTH).alias("page")).agg(
        F.to_json(F.struct(F.collect_list(item).alias("value"))).alias("body")
    )
    rows = bodies.select(F.explode(parse_documents(F.col("body"), "value", FORM_ITEM)).alias("row")).select("row.*")
    return spread_sections(rows, FORM_SECTIONS, tag=("SOURCE_FORM", F.lit("orders_form")))


@register("truncate_seconds", "SELECT event_id, date_trunc('second', ts) AS ts_sec FROM events")
def q_truncate_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Tables(spark, sf_dir).events
    return events.select("event_id", truncate_seconds(F.col("ts")).alias("ts_sec"))
