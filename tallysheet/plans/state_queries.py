"""Upsert, change-tracking and versioning queries (O-08..O-12, O-27, O-45..O-49).

Scenarios are cut from the driver tables by data values (status, segment,
flag), never by id ranges, so every query touches the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.operators.changes import ChangeSpec, detect_changes, reset_changes
from tallysheet.operators.upsert import (
    apply_changes,
    changed_rows,
    fold_sparse,
    insert_new,
    last_per_key,
    upsert,
)
from tallysheet.plans.registry import register
from tallysheet.session import cut_lineage, scratch_path
from tallysheet.sinks.files import append_rows
from tallysheet.sources.sql_scan import query_frames
from tallysheet.sources.tables import Tables

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register(
    "upsert_full",
    f"""WITH t AS (SELECT {ORDER_COLS} FROM orders WHERE o_orderstatus IN ('F', 'O')),
b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
             o_orderpriority || '*' AS o_orderpriority FROM orders WHERE o_orderstatus IN ('O', 'P'))
SELECT COALESCE(t.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
FROM t FULL OUTER JOIN b ON t.o_orderkey = b.o_orderkey""",
)
def q_upsert_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders
    target = orders.where(F.col("o_orderstatus").isin("F", "O"))
    batch = orders.where(F.col("o_orderstatus").isin("O", "P")).withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + F.lit(1.0),
            "o_orderpriority": F.concat("o_orderpriority", F.lit("*")),
        }
    )
    return upsert(target, batch, ["o_orderkey"])


@register(
    "upsert_sparse",
    f"""WITH t AS (SELECT {ORDER_COLS} FROM orders WHERE o_orderstatus IN ('F', 'O')),
raw AS (SELECT l_orderkey AS o_orderkey,
               {{'n': l_linenumber, 'p': l_partkey, 's': l_suppkey, 'd': l_shipdate, 'x': l_extendedprice,
                'r': l_returnflag, 'l': l_linestatus}} AS seq,
               CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS o_totalprice,
               CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS o_orderdate,
               CASE WHEN l_returnflag = 'A' THEN 'A' END AS o_orderstatus
        FROM lineitem),
b AS (SELECT o_orderkey,
             arg_max(o_totalprice, seq) FILTER (WHERE o_totalprice IS NOT NULL) AS o_totalprice,
             arg_max(o_orderdate, seq) FILTER (WHERE o_orderdate IS NOT NULL) AS o_orderdate,
             arg_max(o_orderstatus, seq) FILTER (WHERE o_orderstatus IS NOT NULL) AS o_orderstatus
      FROM raw GROUP BY o_orderkey)
SELECT COALESCE(t.o_orderkey, b.o_orderkey) AS o_orderkey, t.o_custkey,
       COALESCE(b.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
       COALESCE(b.o_totalprice, t.o_totalprice) AS o_totalprice,
       COALESCE(b.o_orderdate, t.o_orderdate) AS o_orderdate, t.o_orderpriority
FROM t FULL OUTER JOIN b ON t.o_orderkey = b.o_orderkey""",
)
def q_upsert_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    target = t.orders.where(F.col("o_orderstatus").isin("F", "O"))
    li = t.lineitem
    # Each line item is a partial document for its order: only some keys present.
    batch = li.select(
        F.col("l_orderkey").alias("o_orderkey"),
        # Document order: line number, then the remaining columns as a tiebreak
        # (line numbers repeat within an order in this data).
        F.struct(
            F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"),
            F.col("l_shipdate").alias("d"), F.col("l_extendedprice").alias("x"),
            F.col("l_returnflag").alias("r"), F.col("l_linestatus").alias("l"),
        ).alias("seq"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).alias("o_totalprice"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("o_orderdate"),
        F.when(F.col("l_returnflag") == "A", F.lit("A")).alias("o_orderstatus"),
    )
    return upsert(target, fold_sparse(batch, ["o_orderkey"], "seq"), ["o_orderkey"], sparse=True)


@register(
    "upsert_do_nothing",
    """WITH t AS (SELECT DISTINCT l_orderkey, l_partkey, 'existing' AS origin FROM lineitem WHERE l_returnflag = 'N'),
b AS (SELECT DISTINCT l_orderkey, l_partkey, 'batch' AS origin FROM lineitem)
SELECT * FROM t
UNION ALL
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.l_orderkey = b.l_orderkey AND t.l_partkey = b.l_partkey)""",
)
def q_upsert_do_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    target = (
        li.where(F.col("l_returnflag") == "N").select("l_orderkey", "l_partkey").distinct()
        .withColumn("origin", F.lit("existing"))
    )
    batch = li.select("l_orderkey", "l_partkey", F.lit("batch").alias("origin"))
    return insert_new(target, batch, ["l_orderkey", "l_partkey"])


def staged_customers(t: Tables) -> DataFrame:
    """Customer as a staging table with a change status taken from the segment."""
    seg = F.col("c_mktsegment")
    change = F.when(seg == "BUILDING", "insert").when(seg == "MACHINERY", "update").otherwise("")
    return t.customer.withColumn("change", change)


@register(
    "changed_rows_scan",
    """SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'insert' ELSE 'update' END AS change
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
)
def q_changed_rows_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_customers(Tables(spark, sf_dir))
    return query_frames(
        spark,
        "SELECT c_custkey, c_name, change FROM {staged} WHERE change = 'insert' OR change = 'update'",
        staged=staged,
    )


@register("flush_changes", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def q_flush_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_customers(Tables(spark, sf_dir))
    warehouse = scratch_path(spark, "warehouse_customer")
    exclude = ["change", "c_acctbal"]
    append_rows(staged.where(F.col("change") == ""), warehouse, exclude)  # exported earlier
    append_rows(changed_rows(staged), warehouse, exclude)  # this flush
    return spark.read.parquet(warehouse)


@register(
    "change_directed_upsert",
    """WITH s AS (SELECT c_custkey,
                     CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN c_name || ' v2' ELSE c_name END AS c_name,
                     c_nationkey, c_acctbal,
                     CASE WHEN c_mktsegment = 'BUILDING' THEN 'insert'
                          WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'update' ELSE '' END AS change
              FROM customer),
t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer
      WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE', 'HOUSEHOLD')),
u AS (SELECT * FROM s WHERE change = 'update')
SELECT t.c_custkey,
       CASE WHEN u.c_custkey IS NOT NULL THEN u.c_name ELSE t.c_name END AS c_name,
       CASE WHEN u.c_custkey IS NOT NULL THEN u.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
       CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE t.c_acctbal END AS c_acctbal
FROM t LEFT JOIN u ON t.c_custkey = u.c_custkey
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM s WHERE change = 'insert'""",
)
def q_change_directed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = Tables(spark, sf_dir).customer
    seg = F.col("c_mktsegment")
    updated = seg.isin("MACHINERY", "AUTOMOBILE")
    staged = customer.select(
        "c_custkey",
        F.when(updated, F.concat("c_name", F.lit(" v2"))).otherwise(F.col("c_name")).alias("c_name"),
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
        F.when(seg == "BUILDING", "insert").when(updated, "update").otherwise("").alias("change"),
    )
    target = customer.where(seg.isin("MACHINERY", "FURNITURE", "HOUSEHOLD")).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal"
    )
    return apply_changes(target, staged, ["c_custkey"], exclude=["c_mktsegment"])


@register(
    "latest_version",
    """SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def q_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Tables(spark, sf_dir).events
    return last_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@register(
    "dedupe_last",
    f"""SELECT {ORDER_COLS} FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
)
def q_dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders
    return last_per_key(orders, ["o_custkey"], ["o_orderkey"])


CUSTOMER_CHANGES = ChangeSpec(keys=["c_custkey"], tracked=["name"], previous={"name": "previous_name"})

_CHANGE_SQL = """WITH o AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_name END AS name,
                  c_acctbal, CAST(NULL AS VARCHAR) AS previous_name,
                  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'insert' ELSE '' END AS change
           FROM customer WHERE c_mktsegment <> 'BUILDING'),
n AS (SELECT c_custkey,
             CASE WHEN c_nationkey = 0 THEN NULL
                  WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN c_name || '-renamed'
                  ELSE c_name END AS name,
             c_acctbal + 1.0 AS c_acctbal
      FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
j AS (SELECT o.*, n.c_custkey AS n_key, n.name AS n_name, n.c_acctbal AS n_acctbal,
             o.c_custkey IS NOT NULL AND n.c_custkey IS NOT NULL AND COALESCE(n.name <> o.name, false) AS changed
      FROM o FULL OUTER JOIN n ON o.c_custkey = n.c_custkey)
SELECT COALESCE(c_custkey, n_key) AS c_custkey,
       CASE WHEN n_key IS NOT NULL THEN n_name ELSE name END AS name,
       CASE WHEN n_key IS NOT NULL THEN n_acctbal ELSE c_acctbal END AS c_acctbal,
       CASE WHEN changed THEN name ELSE previous_name END AS previous_name,
       CASE WHEN c_custkey IS NULL THEN 'insert'
            WHEN changed AND change = 'insert' THEN 'insert'
            WHEN changed THEN 'update' ELSE change END AS change
FROM j"""


def _customer_snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    customer = t.customer
    seg = F.col("c_mktsegment")
    current = customer.where(seg != "BUILDING").select(
        "c_custkey",
        F.when(seg == "FURNITURE", F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("name"),
        "c_acctbal",
        F.lit(None).cast("string").alias("previous_name"),
        F.when(seg == "AUTOMOBILE", "insert").otherwise("").alias("change"),
    )
    incoming = customer.where(seg != "HOUSEHOLD").select(
        "c_custkey",
        F.when(F.col("c_nationkey") == 0, F.lit(None).cast("string"))
        .when(seg.isin("MACHINERY", "AUTOMOBILE"), F.concat("c_name", F.lit("-renamed")))
        .otherwise(F.col("c_name"))
        .alias("name"),
        (F.col("c_acctbal") + F.lit(1.0)).alias("c_acctbal"),
    )
    return current, incoming


@register("change_detect", _CHANGE_SQL)
def q_change_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, incoming = _customer_snapshots(Tables(spark, sf_dir))
    return detect_changes(current, incoming, CUSTOMER_CHANGES)


@register(
    "reset_changes",
    f"""SELECT change AS change_before, CASE WHEN change IN ('insert', 'update') THEN '' ELSE change END AS change_after,
       count(*) AS n
FROM ({_CHANGE_SQL}) s GROUP BY ALL""",
)
def q_reset_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, incoming = _customer_snapshots(Tables(spark, sf_dir))
    # Staged once, as the table it is: the export and the reset read the same snapshot.
    staged = cut_lineage(detect_changes(current, incoming, CUSTOMER_CHANGES).select("c_custkey", "change"))
    flushed = changed_rows(staged).select("c_custkey")  # what the export took
    after = reset_changes(staged.withColumnRenamed("change", "change_before").withColumn(
        "change", F.col("change_before")), ["c_custkey"], flushed)
    return after.groupBy("change_before", F.col("change").alias("change_after")).agg(F.count(F.lit(1)).alias("n"))
