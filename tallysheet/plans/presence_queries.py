"""Partial documents by presence, and forms nobody declared (O-03, O-09, O-17, O-57)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.functions.casts import iso_text
from tallysheet.operators.changes import reset_changes
from tallysheet.plans.endpoints import Endpoint
from tallysheet.plans.flows import stage_present
from tallysheet.plans.registry import SOURCE_URL, register
from tallysheet.session import scratch_path
from tallysheet.sinks.versioned import commit, read_latest
from tallysheet.sources.paging import landed_pages, page_problems
from tallysheet.sources.tables import Tables
from tallysheet.sources.variants import read_mixed_forms

PAGE_WIDTH = 500
PARTIAL_SPEC = {
    "id": {"column": "uid", "type": "str"},
    "lastUpdated": {"column": "lastupdated", "type": "timestamp"},
    "priority": {"column": "priority", "type": "str"},
    "state": {"nestedColumns": {"status": {"column": "status", "type": "str"}}},
}
PARTIAL = Endpoint("customers", PARTIAL_SPEC, "partial", tracked=["priority", "status"])


def _member(key: str, value: Column) -> Column:
    return F.concat(F.lit(f',"{key}":'), F.coalesce(F.concat(F.lit('"'), value, F.lit('"')), F.lit("null")))


def partial_documents(orders: DataFrame) -> DataFrame:
    """One partial document per order about its customer, some keys null, some absent, in pages (a line each)."""
    n, gone = F.col("o_orderkey"), F.lit("")
    stamp = F.timestamp_add("MILLISECOND", n, F.col("o_orderdate"))
    priority = F.when(n % 5 != 1, _member("priority", F.when(n % 5 != 0, F.col("o_orderpriority")))).otherwise(gone)
    status = F.substring(_member("status", F.when(n % 7 != 0, F.col("o_orderstatus"))), 2, 100)
    state = F.when(n % 3 == 1, F.concat(F.lit(',"state":{'), status, F.lit("}"))).when(n % 3 == 2, F.lit(',"state":null')).otherwise(gone)
    document = F.concat(F.lit('{"id":"'), F.col("o_custkey").cast("string"), F.lit('"'), _member("lastUpdated", iso_text(stamp)),
                        priority, state, F.lit("}"))
    pages = orders.groupBy(F.floor(n / PAGE_WIDTH)).agg(F.array_join(F.collect_list(document), ",").alias("items"))
    return pages.select(F.concat(F.lit("["), F.col("items"), F.lit("]")).alias("value"))


@register(
    "presence_staging",
    """WITH d AS (
  SELECT o_custkey, o_orderkey AS n, o_orderdate + to_milliseconds(o_orderkey) AS ts, o_orderdate < TIMESTAMP '1995-01-01' AS early,
         o_orderkey % 5 <> 1 AS has_p, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS p,
         o_orderkey % 3 <> 0 AS has_s, CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 7 <> 0 THEN o_orderstatus END AS s FROM orders
), c AS (
  SELECT o_custkey, last(p ORDER BY ts) FILTER (WHERE has_p) AS priority, last(s ORDER BY ts) FILTER (WHERE has_s) AS status,
         last(p ORDER BY ts) FILTER (WHERE has_p AND early) AS old_p, last(s ORDER BY ts) FILTER (WHERE has_s AND early) AS old_s,
         max(ts) AS lastupdated, bool_or(early) AS known, bool_or(has_p) AS hp, bool_or(has_s) AS hs FROM d GROUP BY 1
)
SELECT CAST(o_custkey AS VARCHAR) AS uid, priority, status, lastupdated, CAST(3 + 4 * hp::INT + 8 * hs::INT AS BIGINT) AS present,
       CASE WHEN NOT known THEN 'insert' WHEN priority IS DISTINCT FROM old_p OR status IS DISTINCT FROM old_s THEN 'update' ELSE '' END AS change
FROM c""",
)
def q_presence_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of partial documents, an export between them: null overwrites, absent keeps."""
    orders, store = Tables(spark, sf_dir).orders, scratch_path(spark, "presence")
    early = F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp")
    for number, part in enumerate((orders.where(early), orders.where(~early))):
        partial_documents(part).write.text(f"{store}/landed{number}")
        stage_present(spark, f"{store}/landed{number}", PARTIAL, store, SOURCE_URL, multi_line=False)
        if number == 0:
            commit(reset_changes(read_latest(spark, f"{store}/partial")), f"{store}/partial")
    return read_latest(spark, f"{store}/partial").select("uid", "priority", "status", "lastupdated", "present", "change")


def land_mixed_forms(orders: DataFrame, name: str) -> dict[str, str]:
    """Three survey forms with different keys, and types that differ between them and inside one; form -> folder."""
    n, path = F.col("o_orderkey"), scratch_path(orders.sparkSession, name)
    key, status = F.struct("o_orderkey"), F.col("o_orderstatus")
    items = {
        "formF": F.to_json(F.struct(key.alias("s1"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"))),
        "formO": F.to_json(F.struct(F.struct("o_orderkey", "o_custkey").alias("s1"), F.floor("o_totalprice").alias("price"),
                                    F.when(n % 2 == 0, F.lit(True)).alias("Checked"))),
        "formP": F.when(n % 2 == 0, F.to_json(F.struct(key.alias("s1"), (n % 9).alias("priority"), F.lit(7).alias("checked")))).otherwise(
            F.to_json(F.struct(key.alias("s1"), F.concat(F.lit("P"), n % 9).alias("priority")))),
    }
    for form, item in items.items():
        part = orders.where(status == form[-1])
        pages = part.groupBy(F.floor(n / PAGE_WIDTH)).agg(F.array_join(F.collect_list(item), ",").alias("items"))
        pages.select(F.concat(F.lit('{"value":['), F.col("items"), F.lit("]}")).alias("value")).write.text(f"{path}/{form}")
    return {form: f"{path}/{form}" for form in items}


@register(
    "mixed_forms",
    """SELECT 'formF' AS SOURCE_FORM, o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, o_orderpriority AS priority, o_totalprice AS price, CAST(NULL AS VARCHAR) AS checked
FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'formO', o_orderkey, o_custkey, NULL, floor(o_totalprice), CASE WHEN o_orderkey % 2 = 0 THEN 'true' END FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'formP', o_orderkey, NULL, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'P' END || (o_orderkey % 9), NULL,
       CASE WHEN o_orderkey % 2 = 0 THEN '7' END FROM orders WHERE o_orderstatus = 'P'""",
)
def q_mixed_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forms' union with the types found in them; nothing is declared."""
    rows, _ = read_mixed_forms(spark, land_mixed_forms(Tables(spark, sf_dir).orders, "mixed_forms"), "value", multi_line=False)
    return rows.select("SOURCE_FORM", "s1.o_orderkey", "s1.o_custkey", "priority", F.col("price").cast("double").alias("price"),
                       F.col("Checked").alias("checked"))


@register(
    "schema_conflicts",
    """SELECT field, string_agg(DISTINCT form, ',' ORDER BY form) AS forms, field IN ('Checked', 'priority') AS conflict FROM (
  SELECT 'form' || o_orderstatus AS form, unnest(CASE o_orderstatus WHEN 'F' THEN ['s1', 'priority', 'price']
    WHEN 'O' THEN ['s1', 'price', CASE WHEN o_orderkey % 2 = 0 THEN 'Checked' END]
    ELSE ['s1', 'priority', CASE WHEN o_orderkey % 2 = 0 THEN 'Checked' END] END) AS field FROM orders)
WHERE field IS NOT NULL GROUP BY field""",
)
def q_schema_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which forms have which keys, and where types disagree (between forms, or inside one)."""
    _, report = read_mixed_forms(spark, land_mixed_forms(Tables(spark, sf_dir).orders, "schema_conflicts"), "value", multi_line=False)
    return report.select("field", "forms", "conflict")


def land_pages(customer: DataFrame) -> str:
    """Customer pages with a pager, as a pull that went wrong: pages lost, one list object on two pages, pages taken twice."""
    key, path = F.col("c_custkey"), scratch_path(customer.sparkSession, "pages")
    page = F.floor(key / 50) + 1
    last = key % 50 == 49
    rows = customer.select(page.alias("page"), key.alias("id")).unionByName(
        customer.where(last & (key % 100 == 99)).select((page + 1).alias("page"), key.alias("id")))
    pages = rows.groupBy("page").agg(F.collect_list(F.struct("id")).alias("items")).where((F.col("page") % 9 > 1) | (F.col("page") == 1))
    pages = pages.withColumns({"total": customer.select(F.count(F.lit(1))).scalar(), "pageCount": customer.select(F.max(page)).scalar()})
    body = F.to_json(F.struct(F.struct("page", "pageCount", "total").alias("pager"), F.col("items").alias("customers")))
    twice = F.explode(F.when(F.col("page") % 11 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    pages.select(body.alias("value"), twice.alias("copy")).select("value").write.text(path)
    return path


@register(
    "page_check",
    """WITH p AS (SELECT c_custkey AS id, CAST(floor(c_custkey / 50) AS BIGINT) + 1 AS page FROM customer
  UNION ALL SELECT c_custkey, CAST(floor(c_custkey / 50) AS BIGINT) + 2 FROM customer WHERE c_custkey % 100 = 99
), n AS (SELECT max(page) AS upto FROM (SELECT CAST(floor(c_custkey / 50) AS BIGINT) + 1 AS page FROM customer)
), l AS (SELECT * FROM p WHERE page % 9 > 1 OR page = 1
), gaps AS (
  SELECT g, g - row_number() OVER (ORDER BY g) AS island
  FROM (SELECT unnest(generate_series(1, greatest((SELECT upto FROM n), (SELECT max(page) FROM l)))) AS g) WHERE g NOT IN (SELECT page FROM l)
), held AS (SELECT id, min(page) AS first, max(page) AS last FROM l GROUP BY id)
SELECT 'missing' AS problem, min(g) AS first, max(g) AS last, count(*) AS found FROM gaps GROUP BY island
UNION ALL SELECT DISTINCT 'repeated', page, page, 2 FROM l WHERE page % 11 = 5
UNION ALL SELECT 'overlap', min(first), max(last), count(*) FROM held WHERE first <> last HAVING count(*) > 0
UNION ALL SELECT 'total', NULL, (SELECT count(*) FROM customer), count(*) FROM held HAVING count(*) <> (SELECT count(*) FROM customer)""",
)
def q_page_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a broken pull of customer pages lacks, has twice, and holds on two pages."""
    path = land_pages(Tables(spark, sf_dir).customer)
    return page_problems(landed_pages(spark, path, "customers", multi_line=False)).select("problem", "first", "last", "found")
