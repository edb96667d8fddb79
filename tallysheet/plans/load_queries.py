"""Incremental-load, unnest, sink and scalar queries (O-15, O-16, O-28..O-30, O-38, O-54, O-58, §2.10a)."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.casts import (
    datetime_text,
    day_text,
    iso_text,
    parse_timestamp,
    truncate_seconds,
    try_number,
)
from tallysheet.functions.keys import composite_key, sanitize_col
from tallysheet.operators.incremental import group_members, having_data, leaves, next_mark, since_mark
from tallysheet.operators.unnest import explode_links
from tallysheet.plans.registry import SOURCE_URL, register
from tallysheet.plans.warehouse_queries import org_units
from tallysheet.session import scratch_path
from tallysheet.sinks.bucketed import upsert_bucketed, write_bucketed
from tallysheet.sinks.files import write_partitioned
from tallysheet.sinks.payload import payload_chunks
from tallysheet.sources.tables import Tables
from tallysheet.streaming.incremental_load import read_current, start_upsert_stream

MARK = "2024-01-15 00:00:00"


@register(
    "incremental_hwm",
    f"""SELECT event_id, ts, user_id, event_type,
       COALESCE((SELECT max(ts) FROM events WHERE ts >= TIMESTAMP '{MARK}'), TIMESTAMP '{MARK}') AS next_mark
FROM events WHERE ts >= TIMESTAMP '{MARK}'""",
)
def q_incremental_hwm(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type")
    fresh = since_mark(events, "ts", MARK)
    return fresh.withColumn("next_mark", next_mark(fresh, "ts", MARK))


_LEAF_SQL = """SELECT 'C' || c_custkey AS uid, c_name AS name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders)"""


@register("leaf_data", _LEAF_SQL)
def q_leaf_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    units = org_units(t).withColumn("leaf", F.regexp_count(F.col("path"), F.lit("/")) == 3)
    landed = t.orders.select(F.concat(F.lit("C"), F.col("o_custkey")).alias("uid"))
    return having_data(leaves(units), landed, "uid").select("uid", "name")


GROUPS = ["Brand#1", "Brand#2", "Brand#3"]


@register(
    "group_semi_filter",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand IN ({", ".join(f"'{g}'" for g in GROUPS)}))""",
)
def q_group_semi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return group_members(facts, t.part, GROUPS, "l_partkey", "p_partkey", "p_brand")


ORDER_DOC_SPEC = {"o_orderkey": {"column": "order_id", "type": "long"}}
DOC_PAGE = 1000  # children per landed document page
LINES_PER_TASK = 500_000
LINE_SPEC = {"l_partkey": {"column": "part_id", "type": "long"}}


@register(
    "mn_explode",
    f"""SELECT DISTINCT l_orderkey AS order_id, md5('{SOURCE_URL}') AS sourceid, l_partkey AS part_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def q_mn_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    # Order documents with their line lists, paged like an API: a page holds at most
    # DOC_PAGE consecutive rows of one input split, so even an order holding a third
    # of all lines never becomes one giant list.
    page = F.floor(F.monotonically_increasing_id() / F.lit(DOC_PAGE)).alias("_page")
    # Dealt once, by order, into parts of about LINES_PER_TASK lines: lists, join and links
    # need no other shuffle, and more lines make more tasks, not larger ones.
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(t.lineitem.count() / LINES_PER_TASK))
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", page).repartition(parts, "l_orderkey")
    lines = rows.groupBy("l_orderkey", "_page").agg(F.collect_list(F.struct("l_partkey", "l_linenumber")).alias("lines"))
    orders = t.orders.select("o_orderkey", "o_orderstatus").repartition(parts, "o_orderkey")
    docs = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_orderstatus", "lines")
    links = explode_links(docs, ORDER_DOC_SPEC, "lines", LINE_SPEC, SOURCE_URL)
    # Link rows are all key columns: a repeated link is inserted once (DO NOTHING).
    return links.dropDuplicates(["order_id", "sourceid", "part_id"])


@register(
    "payload_chunks",
    """WITH n AS (SELECT o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, rn,
                  CAST(floor((rn - 1) / 30) AS BIGINT) AS chunk
           FROM (SELECT *, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS rn FROM orders))
SELECT chunk, count(*) AS n,
       md5('{"dataValues":[' || string_agg(json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey,
           'o_orderstatus', o_orderstatus, 'o_orderdate', o_orderdate)::VARCHAR, ',' ORDER BY rn) || ']}') AS payload_md5
FROM n GROUP BY chunk""",
)
def q_payload_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders.select(
        "o_orderpriority", "o_orderkey", "o_custkey", "o_orderstatus",
        day_text(F.col("o_orderdate")).alias("o_orderdate"),
    )
    chunks = payload_chunks(orders, ["o_orderpriority", "o_orderkey"],
                            ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    return chunks.select("chunk", "n", F.md5("payload").alias("payload_md5"))


@register(
    "partitioned_write",
    "SELECT o_orderpriority, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS custkey_sum FROM orders GROUP BY o_orderpriority",
)
def q_partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders_by_priority")
    orders = Tables(spark, sf_dir).orders
    write_partitioned(orders, path, ["o_orderpriority"])
    back = spark.read.schema(orders.schema).parquet(path)
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("custkey_sum"))


@register(
    "scalar_tour",
    """SELECT o_orderkey,
       md5(o_orderpriority) AS f_md5,
       o_orderdate AS f_parsed,
       strftime(o_orderdate, '%Y-%m-%d') AS f_day,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS f_datetime,
       date_trunc('second', o_orderdate) AS f_trunc,
       replace(o_orderpriority, ' ', '') AS f_nospace,
       replace(strftime(o_orderdate, '%Y-%m-%d'), '-', '') AS f_period,
       length(trim(o_orderpriority)) > 0 AS f_nonempty,
       split_part(o_orderpriority, '-', 2) AS f_second_part,
       CAST(length(o_orderpriority) - length(replace(o_orderpriority, '-', '')) AS INTEGER) AS f_dashes,
       concat_ws('-', o_orderkey, o_custkey) AS f_key,
       CAST(o_orderkey AS VARCHAR) AS f_text,
       TRY_CAST(o_orderstatus AS INTEGER) AS f_int,
       COALESCE(TRY_CAST(o_orderstatus AS INTEGER), 0) AS f_filled,
       json_object('k', o_orderkey)::VARCHAR AS f_json,
       o_orderkey AS f_json_k,
       o_orderstatus IN ('F', 'O') AS f_has_key,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS f_lookup,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS f_merged,
       o_orderpriority AS f_decoded
FROM orders""",
)
def q_scalar_tour(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    status_codes = F.create_map(F.lit("F"), F.lit(1), F.lit("O"), F.lit(2))
    json_text = F.to_json(F.struct(F.col("o_orderkey").alias("k")))
    iso = F.concat(iso_text(F.col("o_orderdate")), F.lit("+0000 trailing"))
    return o.select(
        "o_orderkey",
        F.md5("o_orderpriority").alias("f_md5"),
        parse_timestamp(iso).alias("f_parsed"),
        day_text(F.col("o_orderdate")).alias("f_day"),
        datetime_text(F.col("o_orderdate")).alias("f_datetime"),
        truncate_seconds(F.col("o_orderdate")).alias("f_trunc"),
        sanitize_col(F.col("o_orderpriority")).alias("f_nospace"),
        F.replace(day_text(F.col("o_orderdate")), F.lit("-"), F.lit("")).alias("f_period"),
        (F.length(F.trim("o_orderpriority")) > 0).alias("f_nonempty"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("f_second_part"),
        F.regexp_count("o_orderpriority", F.lit("-")).alias("f_dashes"),
        composite_key(["o_orderkey", "o_custkey"]).alias("f_key"),
        F.col("o_orderkey").cast("string").alias("f_text"),
        try_number(F.col("o_orderstatus"), T.IntegerType()).alias("f_int"),
        F.coalesce(try_number(F.col("o_orderstatus"), T.IntegerType()), F.lit(0)).alias("f_filled"),
        json_text.alias("f_json"),
        F.from_json(json_text, "k bigint").getField("k").alias("f_json_k"),
        F.map_contains_key(status_codes, F.col("o_orderstatus")).alias("f_has_key"),
        F.try_element_at(status_codes, F.col("o_orderstatus")).alias("f_lookup"),
        F.coalesce(
            F.try_element_at(F.map_concat(status_codes, F.create_map(F.lit("P"), F.lit(3))), F.col("o_orderstatus")),
            F.lit(3),
        ).alias("f_merged"),
        F.decode(F.encode("o_orderpriority", "UTF-8"), "UTF-8").alias("f_decoded"),
    )


@register(
    "stream_upsert",
    """SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Tables(spark, sf_dir).events
    landing = scratch_path(spark, "events_landing")
    # Land the events as several files in time order: each file is one arriving slice.
    events.repartitionByRange(4, "ts").write.mode("overwrite").parquet(landing)
    table = scratch_path(spark, "events_table")
    query = start_upsert_stream(
        spark, landing, events.schema, table, ["user_id", "event_type"], ["ts", "event_id"],
        checkpoint=scratch_path(spark, "events_stream_ckpt"), max_files_per_trigger=2,
    )
    query.awaitTermination()
    return read_current(spark, table, ["user_id", "event_type"], ["ts", "event_id"])


@register(
    "bucketed_upsert",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 3 AND o_orderdate < TIMESTAMP '1995-01-01' THEN o_totalprice * 2 ELSE o_totalprice END
  AS o_totalprice, CASE WHEN o_orderkey % 10 = 3 OR o_orderdate >= TIMESTAMP '1995-01-01' THEN 'batch' ELSE 'stored' END AS origin FROM orders""",
)
def q_bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the first years as a bucketed table; the later ones, and some changed ones, are upserted: only they are shuffled."""
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    early = F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp")
    table, base = f"bucketed_{uuid.uuid4().hex[:12]}", scratch_path(spark, "bucketed")
    write_bucketed(orders.where(early).drop("o_orderdate").withColumn("origin", F.lit("stored")), table, ["o_orderkey"], 16, base)
    price = F.when(early, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))
    batch = orders.where(~early | (F.col("o_orderkey") % 10 == 3)).withColumn("o_totalprice", price).drop("o_orderdate")
    upsert_bucketed(spark, table, batch.withColumn("origin", F.lit("batch")))
    return spark.table(table)
