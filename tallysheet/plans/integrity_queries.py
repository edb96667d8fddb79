"""Integrity and schema-evolution queries (O-39, O-50..O-53)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.functions.casts import load_timestamp
from tallysheet.functions.keys import source_key
from tallysheet.operators.quality import Rule, duplicate_keys, fk_violations, rule_violations
from tallysheet.operators.schema_evolution import apply_plan, schema_plan
from tallysheet.plans.registry import SOURCE_URL, register
from tallysheet.session import bounded_rows
from tallysheet.sources.tables import Tables

AS_OF = "2024-01-31 00:00:00"


@register(
    "fk_violations",
    """WITH cust AS (SELECT * FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'),
ord AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus
        FROM orders),
link AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'R')
SELECT 'fk_orders_customer' AS fk, CAST(o_custkey AS VARCHAR) AS child_key, count(*) AS n FROM ord
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cust WHERE c_custkey = o_custkey) GROUP BY o_custkey
UNION ALL
SELECT 'fk_lineitem_orders', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM ord WHERE ord.o_orderkey = l_orderkey AND ord.o_orderstatus <> 'P') GROUP BY l_orderkey
UNION ALL
SELECT 'fk_lineitem_partsupp', CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR), count(*) FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM link WHERE link.l_partkey = l.l_partkey AND link.l_suppkey = l.l_suppkey)
GROUP BY l.l_partkey, l.l_suppkey""",
)
def q_fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    customers = t.customer.where(F.col("c_mktsegment") != "AUTOMOBILE")
    orders = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
    )
    li = t.lineitem
    partsupp = li.where(F.col("l_returnflag") != "R").select("l_partkey", "l_suppkey")
    checks = [
        fk_violations(orders, customers, ["o_custkey"], ["c_custkey"], "fk_orders_customer"),
        fk_violations(li, orders.where(F.col("o_orderstatus") != "P"), ["l_orderkey"], ["o_orderkey"],
                      "fk_lineitem_orders"),
        fk_violations(li, partsupp, ["l_partkey", "l_suppkey"], ["l_partkey", "l_suppkey"], "fk_lineitem_partsupp"),
    ]
    return reduce(DataFrame.unionByName, checks)


LANGS = ["en", "de", "fr", "es"]
DOCUMENT_RULES = [
    Rule("documents.doc_id.not_null", "not_null", "doc_id"),
    Rule("documents.text.not_null", "not_null", "text"),
    Rule("documents.text.max_length", "max_length", "text", 50000),
    Rule("documents.lang.domain", "domain", "lang", LANGS),
    Rule("documents.source.max_length", "max_length", "source", 4),
]
LABEL_RULES = [
    Rule("labels.quality.domain", "domain", "quality", [0, 1]),
    Rule("labels.toxic.domain", "domain", "toxic", [0, 1]),
    Rule("labels.doc_id.not_null", "not_null", "doc_id"),
]
PAGE_RULES = [
    Rule("pages.url.not_null", "not_null", "url"),
    Rule("pages.url.max_length", "max_length", "url", 40),
    Rule("pages.html.not_null", "not_null", "html"),
]


def _rule_sql(table: str, rules: list[Rule], key: str) -> str:
    parts = []
    for r in rules:
        if r.kind == "not_null":
            cond = f"{r.column} IS NULL"
        elif r.kind == "max_length":
            cond = f"length({r.column}) > {r.arg}"
        else:
            values = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r.arg)
            cond = f"{r.column} IS NOT NULL AND {r.column} NOT IN ({values})"
        parts.append(f"SELECT '{r.name}' AS rule, coalesce(CAST({key} AS VARCHAR), '?') AS key, count(*) AS n "
                     f"FROM {table} WHERE {cond} GROUP BY {key}")
    return "\nUNION ALL ".join(parts)


def _dupes_sql(table: str, key: str) -> str:
    return (f"SELECT '{table}.pk' AS rule, coalesce(CAST({key} AS VARCHAR), '?') AS key, count(*) AS n "
            f"FROM {table} GROUP BY {key} HAVING count(*) > 1")


@register(
    "dq_violations",
    "\nUNION ALL ".join(
        [
            _rule_sql("documents", DOCUMENT_RULES, "doc_id"),
            _rule_sql("labels", LABEL_RULES, "doc_id"),
            _rule_sql("pages", PAGE_RULES, "page_id"),
            _dupes_sql("documents", "doc_id"),
            _dupes_sql("labels", "doc_id"),
            _dupes_sql("pages", "page_id"),
        ]
    ),
)
def q_dq_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    checks = [
        rule_violations(t.documents, DOCUMENT_RULES, ["doc_id"]),
        rule_violations(t.labels, LABEL_RULES, ["doc_id"]),
        rule_violations(t.pages, PAGE_RULES, ["page_id"]),
        duplicate_keys(t.documents, ["doc_id"], "documents.pk"),
        duplicate_keys(t.labels, ["doc_id"], "labels.pk"),
        duplicate_keys(t.pages, ["page_id"], "pages.pk"),
    ]
    return reduce(DataFrame.unionByName, checks)


# ---- schema evolution -------------------------------------------------------------


def nation_metadata(t: Tables) -> DataFrame:
    """Nations that customers reference, as category metadata with a change status."""
    nation = t.nation.join(t.customer.select(F.col("c_nationkey").alias("n_nationkey")), "n_nationkey", "left_semi")
    name = F.replace(F.col("n_name"), F.lit("_"), F.lit(" "))
    region = F.col("n_regionkey")
    return nation.select(
        "n_nationkey",
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("uid"),
        name.alias("name"),
        F.concat(name, F.lit(" old")).alias("previous_name"),
        F.when(region.isin(0, 2), "insert").when(region == 1, "update").otherwise("").alias("change"),
    )


_META_SQL = """SELECT n_nationkey, 'N' || n_nationkey AS uid, replace(n_name, '_', ' ') AS name,
       replace(n_name, '_', ' ') || ' old' AS previous_name,
       CASE WHEN n_regionkey IN (0, 2) THEN 'insert' WHEN n_regionkey = 1 THEN 'update' ELSE '' END AS change
FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)"""

_PLAN_SQL = f"""WITH meta AS ({_META_SQL}),
ch AS (SELECT *, replace(name, ' ', '') AS sname, replace(previous_name, ' ', '') AS sprev,
              row_number() OVER (ORDER BY n_nationkey) AS rn,
              last_value(CASE WHEN change = 'insert' THEN replace(name, ' ', '') END IGNORE NULLS)
                OVER (ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
              count(*) OVER (PARTITION BY replace(name, ' ', '')) > 1 AS collides
       FROM meta WHERE change IN ('insert', 'update'))
SELECT rn * 2 AS seq, 'ADD' AS action, uid AS column_name, COALESCE(prev, 'lastupdated') AS anchor,
       (SELECT count(*) FROM ch c2 WHERE c2.sname = ch.uid) > 1 AS collides FROM ch WHERE change = 'insert'
UNION ALL SELECT rn * 2 + 1, 'ADD', sname, uid, collides FROM ch WHERE change = 'insert'
UNION ALL SELECT rn * 2, 'RENAME', sname, sprev, collides FROM ch WHERE change = 'update'"""


@register("schema_plan", _PLAN_SQL)
def q_schema_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_plan(nation_metadata(Tables(spark, sf_dir)), ["n_nationkey"])


# Nations of regions 0-2 in the driver's nation table (identical at every scale
# factor): they end up with a uid column and a name column each.
EVOLVED_NATIONS = [0, 1, 2, 5, 6, 7, 10, 11, 12, 15, 16, 17, 20, 21, 22]


def _apply_sql() -> str:
    cols = ", ".join(f"'' AS \"N{k}\", '' AS \"NATION{k}\"" for k in EVOLVED_NATIONS)
    return f"""SELECT 'C' || c_custkey AS uid, c_name AS name, md5('{SOURCE_URL}') AS sourceid,
       TIMESTAMP '{AS_OF}' AS lastupdated, {cols}
FROM customer"""


def wide_customers(t: Tables) -> DataFrame:
    """The warehouse table before this run: base columns plus the columns of earlier runs.

    Nations being renamed already have their uid and old-name columns.
    """
    meta = bounded_rows(nation_metadata(t).where(F.col("change") == "update").orderBy("n_nationkey"), "renamed columns")
    earlier = []
    for r in meta:
        earlier += [F.lit("").alias(r["uid"]), F.lit("").alias(r["previous_name"].replace(" ", ""))]
    return t.customer.select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("uid"),
        F.col("c_name").alias("name"),
        source_key(SOURCE_URL).alias("sourceid"),
        load_timestamp(AS_OF).alias("lastupdated"),
        *earlier,
    )


@register("schema_apply", _apply_sql())
def q_schema_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return apply_plan(wide_customers(t), schema_plan(nation_metadata(t), ["n_nationkey"]))
