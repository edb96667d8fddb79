"""Dimension-building queries: joins, hierarchy, option maps, pivots (O-33..O-36, O-42..O-44, O-56).

Table analogs: orders are category option combos, parts are category
options, brands are categories / groups, suppliers are data elements, and
region -> nation -> customer is the org-unit tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.functions.casts import load_timestamp
from tallysheet.operators.hierarchy import flatten_hierarchy, level_columns
from tallysheet.operators.ordering import files_read, global_ordinal, z_order_for_write
from tallysheet.operators.upsert import changed_rows
from tallysheet.operators.widen import (
    fold_option_map,
    group_count,
    in_group,
    map_as_text,
    membership_flags,
    membership_words,
    pivot_options,
)
from tallysheet.plans.registry import register
from tallysheet.session import bounded_rows, scratch_path
from tallysheet.sources.tables import Tables

AS_OF = "2024-01-31 00:00:00"

# Metadata lists of the driver tables (identical at every scale factor); the
# Spark side collects them from the data, the oracle SQL spells them out.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
BRANDS = [f"Brand#{i}" for i in range(1, 26)]


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


# ---- joins --------------------------------------------------------------------


def part_change(col_size: str = "p_size"):
    size = F.col(col_size)
    return F.when(size <= 10, "insert").when(size >= 40, "update").otherwise("")


def brand_dimension(part: DataFrame) -> DataFrame:
    """Categories: one row per brand (uid derived from the brand text)."""
    return part.select(
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("BR")).alias("category_uid"),
        F.col("p_brand").alias("category_name"),
    ).distinct()


@register(
    "category_join",
    """WITH deco AS (SELECT p_partkey, p_name, p_brand,
                     CASE WHEN p_size <= 10 THEN 'insert' WHEN p_size >= 40 THEN 'update' ELSE '' END AS change
              FROM part),
cocco AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
de_c AS (SELECT DISTINCT replace(p_brand, 'Brand#', 'BR') AS category_uid, p_brand AS category_name FROM part)
SELECT coc.o_orderkey AS coc_uid, coc.o_orderpriority AS coc_name, de_c.category_uid, de_c.category_name,
       deco.p_partkey AS option_uid, deco.p_name AS option_name
FROM orders AS coc
JOIN cocco ON coc.o_orderkey = cocco.l_orderkey
JOIN deco ON cocco.l_partkey = deco.p_partkey
JOIN part AS decco ON decco.p_partkey = deco.p_partkey
JOIN de_c ON de_c.category_name = decco.p_brand
WHERE deco.change IN ('insert', 'update')""",
)
def q_category_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    coc = t.orders.select(F.col("o_orderkey").alias("coc_uid"), F.col("o_orderpriority").alias("coc_name"))
    cocco = t.lineitem.select(F.col("l_orderkey").alias("coc_uid"), F.col("l_partkey").alias("option_uid")).distinct()
    deco = changed_rows(
        t.part.select(F.col("p_partkey").alias("option_uid"), F.col("p_name").alias("option_name"),
                      part_change().alias("change"))
    ).drop("change")
    decco = t.part.select(F.col("p_partkey").alias("option_uid"), F.col("p_brand").alias("category_name"))
    # Categories come out of an aggregation, which ends in a shuffle stage anyway:
    # AQE sees its real size there and broadcasts it (sort-merge join beyond the
    # threshold); a probe here would recompute the aggregation.
    de_c = brand_dimension(t.part)
    return (
        coc.join(cocco, "coc_uid")
        .join(deco, "option_uid")
        .join(decco, "option_uid")
        .join(de_c, "category_name")
        .select("coc_uid", "coc_name", "category_uid", "category_name", "option_uid", "option_name")
    )


@register(
    "group_join",
    """SELECT p.p_partkey, p.p_name, s.s_suppkey, s.s_name
FROM part p JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) link ON p.p_partkey = link.l_partkey
JOIN supplier s ON s.s_suppkey = link.l_suppkey""",
)
def q_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    link = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")).distinct()
    return (
        t.part.select("p_partkey", "p_name")
        .join(link, "p_partkey")
        .join(t.supplier.select("s_suppkey", "s_name"), "s_suppkey")
        .select("p_partkey", "p_name", "s_suppkey", "s_name")
    )


# ---- hierarchy ----------------------------------------------------------------


def org_units(t: Tables) -> DataFrame:
    """region -> nation -> customer as org units with materialised paths."""
    region = t.region.select(
        F.concat(F.lit("R"), F.col("r_regionkey")).alias("uid"), F.col("r_name").alias("name"),
        F.concat(F.lit("/R"), F.col("r_regionkey")).alias("path"),
    )
    nation_path = F.concat(F.lit("/R"), F.col("n_regionkey"), F.lit("/N"), F.col("n_nationkey"))
    nation = t.nation.select(
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("uid"), F.col("n_name").alias("name"),
        nation_path.alias("path"),
    )
    nations = F.broadcast(t.nation.select("n_nationkey", "n_regionkey"))  # 25 rows by definition
    customer = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("uid"), F.col("c_name").alias("name"),
        F.concat(nation_path, F.lit("/C"), F.col("c_custkey")).alias("path"),
    )
    return region.unionByName(nation).unionByName(customer)


def org_levels(spark: SparkSession) -> DataFrame:
    """The level table: three levels, one per tree depth."""
    rows = [("lvlRegion", "Region", 1), ("lvlNation", "Nation", 2), ("lvlCustomer", "Customer", 3)]
    return spark.createDataFrame(rows, "uid string, name string, level int")


_UNITS_SQL = """SELECT 'R' || r_regionkey AS uid, r_name AS name, '/R' || r_regionkey AS path FROM region
 UNION ALL SELECT 'N' || n_nationkey, n_name, '/R' || n_regionkey || '/N' || n_nationkey FROM nation
 UNION ALL SELECT 'C' || c_custkey, c_name, '/R' || n_regionkey || '/N' || n_nationkey || '/C' || c_custkey
           FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""


@register(
    "hierarchy_flatten",
    f"""WITH one AS ({_UNITS_SQL}),
u AS (SELECT 'A' AS sourceid, uid, name, path FROM one UNION ALL SELECT 'B', uid, name || ' B', path FROM one),
p AS (SELECT sourceid, uid, name, path, string_split(path, '/') AS parts FROM u)
SELECT p.uid, p.name, p.sourceid, CAST(length(p.path) - length(replace(p.path, '/', '')) AS INTEGER) AS level,
       COALESCE(NULLIF(p.parts[2], ''), '') AS lvlRegion, CASE WHEN NULLIF(p.parts[2], '') IS NULL THEN '' ELSE COALESCE(a1.name, '') END AS Region,
       COALESCE(NULLIF(p.parts[3], ''), '') AS lvlNation, CASE WHEN NULLIF(p.parts[3], '') IS NULL THEN '' ELSE COALESCE(a2.name, '') END AS Nation,
       COALESCE(NULLIF(p.parts[4], ''), '') AS lvlCustomer, CASE WHEN NULLIF(p.parts[4], '') IS NULL THEN '' ELSE COALESCE(a3.name, '') END AS Customer
FROM p LEFT JOIN u a1 ON a1.uid = p.parts[2] AND a1.sourceid = p.sourceid
LEFT JOIN u a2 ON a2.uid = p.parts[3] AND a2.sourceid = p.sourceid
LEFT JOIN u a3 ON a3.uid = p.parts[4] AND a3.sourceid = p.sourceid""",
)
def q_hierarchy_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources with the same uids and paths and different names: each resolves among its own."""
    one = org_units(Tables(spark, sf_dir))
    units = one.select(F.lit("A").alias("sourceid"), "uid", "name", "path").unionByName(
        one.select(F.lit("B").alias("sourceid"), "uid", F.concat("name", F.lit(" B")).alias("name"), "path"))
    return flatten_hierarchy(units, level_columns(org_levels(spark)), keep=["sourceid"], source="sourceid")


@register(
    "sorted_levels",
    f"""WITH u AS ({_UNITS_SQL})
SELECT uid, CAST(length(path) - length(replace(path, '/', '')) AS INTEGER) AS level,
       row_number() OVER (ORDER BY length(path) - length(replace(path, '/', '')), uid) AS rn
FROM u""",
)
def q_sorted_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = org_units(Tables(spark, sf_dir)).select(
        "uid", F.regexp_count(F.col("path"), F.lit("/")).alias("level")
    )
    return global_ordinal(units, ["level", "uid"], "rn")


# ---- option maps and pivots -------------------------------------------------------


def combo_links(t: Tables) -> DataFrame:
    """Customer (combo) -> priority (category) -> order (option) links."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey",
        "c_name",
        F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1)).alias("cat_uid"),
        F.col("o_orderpriority").alias("cat_name"),
        F.col("o_orderkey").cast("string").alias("opt_uid"),
        F.col("o_orderstatus").alias("opt_name"),
        F.col("o_orderkey").alias("ord"),
        F.when(F.col("o_orderstatus") == "F", "A").otherwise("B").alias("sourceid"),
    )


_LINKS_SQL = """SELECT c_custkey, c_name, CASE WHEN o_orderstatus = 'F' THEN 'A' ELSE 'B' END AS sourceid, 'P' || substr(o_orderpriority, 1, 1) AS cat_uid, o_orderpriority AS cat_name,
       CAST(o_orderkey AS VARCHAR) AS opt_uid, o_orderstatus AS opt_name, o_orderkey AS ord
FROM orders JOIN customer ON o_custkey = c_custkey"""


@register(
    "option_map",
    f"""WITH links AS ({_LINKS_SQL}),
e AS (SELECT c_custkey, cat_uid AS k, opt_uid AS v, ord FROM links
      UNION ALL SELECT c_custkey, cat_name, opt_name, ord FROM links),
last AS (SELECT c_custkey, k, arg_max(v, ord) AS v FROM e GROUP BY c_custkey, k),
names AS (SELECT c_custkey, arg_min(c_name, ord) AS c_name FROM links GROUP BY c_custkey)
SELECT names.c_custkey, names.c_name, string_agg(k || '=' || v, ';' ORDER BY k || '=' || v) AS options_text
FROM last JOIN names ON last.c_custkey = names.c_custkey GROUP BY names.c_custkey, names.c_name""",
)
def q_option_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = combo_links(Tables(spark, sf_dir))
    folded = fold_option_map(links, "c_custkey", "c_name", "cat_uid", "cat_name", "opt_uid", "opt_name", "ord")
    return folded.select("c_custkey", "c_name", map_as_text(F.col("options")).alias("options_text"))


def _category_wide_sql() -> str:
    cells = []
    for p in PRIORITIES:
        uid = "P" + p[0]
        cells.append(f"COALESCE(max(CASE WHEN cat_uid = '{uid}' THEN opt_uid END), '') AS {_q(uid)}")
        cells.append(f"COALESCE(max(CASE WHEN cat_uid = '{uid}' THEN opt_name END), '') AS {_q(p.replace(' ', ''))}")
    return f"""WITH links AS ({_LINKS_SQL}),
last AS (SELECT c_custkey, sourceid, cat_uid, arg_max(opt_uid, ord) AS opt_uid, arg_max(opt_name, ord) AS opt_name
         FROM links GROUP BY c_custkey, sourceid, cat_uid),
names AS (SELECT c_custkey, arg_min(c_name, ord) AS c_name FROM links GROUP BY c_custkey)
SELECT CAST(last.c_custkey AS VARCHAR) AS categoryoptioncomboid, names.c_name AS categoryoptioncomboname,
       last.sourceid, TIMESTAMP '{AS_OF}' AS lastupdated,
       {", ".join(cells)}
FROM last JOIN names ON last.c_custkey = names.c_custkey
GROUP BY last.c_custkey, last.sourceid, names.c_name"""


@register("category_wide", _category_wide_sql())
def q_category_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combos that two sources share stay two rows; the columns come from the category metadata."""
    links = combo_links(Tables(spark, sf_dir))
    categories = [("P" + p[0], p) for p in PRIORITIES]
    wide = pivot_options(links, ["c_custkey", "sourceid"], categories, "cat_uid", "opt_uid", "opt_name", "ord",
                         carry=["c_name"])
    value_cols = [c for c in wide.columns if c not in ("c_custkey", "sourceid", "c_name")]
    return wide.select(
        F.col("c_custkey").cast("string").alias("categoryoptioncomboid"),
        F.col("c_name").alias("categoryoptioncomboname"),
        "sourceid",
        load_timestamp(AS_OF).alias("lastupdated"),
        *[F.col(f"`{c}`") for c in value_cols],
    )


def _group_flags_sql() -> str:
    cells = []
    for b in BRANDS:
        uid = b.replace("Brand#", "BR")
        flag = f"CASE WHEN bool_or(brand = '{b}') THEN 't' ELSE '' END"
        cells.append(f"{flag} AS {_q(uid)}")
        cells.append(f"{flag} AS {_q(b)}")
    return f"""WITH m AS (SELECT DISTINCT l_suppkey, CASE WHEN l_returnflag = 'R' THEN 'B' ELSE 'A' END AS sourceid, p_brand AS brand
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT s_suppkey AS uid, s_name AS name, sourceid, TIMESTAMP '{AS_OF}' AS lastupdated,
       {", ".join(cells)}
FROM m JOIN supplier ON m.l_suppkey = s_suppkey GROUP BY s_suppkey, s_name, sourceid"""


@register("group_flags", _group_flags_sql())
def q_group_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    source = F.when(F.col("l_returnflag") == "R", "B").otherwise("A").alias("sourceid")
    # Distinct links first: a hot part is a row per supplier and source before the join.
    links = t.lineitem.select("l_partkey", F.col("l_suppkey").alias("uid"), source).distinct()
    links = links.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "uid", "sourceid", F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("BR")).alias("group_uid")
    )
    brands = bounded_rows(brand_dimension(t.part).orderBy("category_uid"), "groups")
    groups = [(r["category_uid"], r["category_name"]) for r in brands]
    flags = membership_flags(links, ["uid", "sourceid"], groups, "group_uid")
    elements = t.supplier.select(F.col("s_suppkey").alias("uid"), F.col("s_name").alias("name"))
    return elements.join(flags, "uid").select(
        "uid", "name", "sourceid", load_timestamp(AS_OF).alias("lastupdated"),
        *[F.col(f"`{c}`") for c in flags.columns if c not in ("uid", "sourceid")],
    )


MANY_GROUPS = 5_000


@register(
    "group_bitmaps",
    f"""SELECT l_suppkey AS uid, CAST(count(DISTINCT l_orderkey % {MANY_GROUPS}) AS INTEGER) AS n_groups, bool_or(l_orderkey % {MANY_GROUPS} = 0) AS in_first,
       bool_or(l_orderkey % {MANY_GROUPS} = 62) AS in_63rd, bool_or(l_orderkey % {MANY_GROUPS} = 63) AS in_64th,
       bool_or(l_orderkey % {MANY_GROUPS} = {MANY_GROUPS - 1}) AS in_last
FROM lineitem GROUP BY l_suppkey""",
)
def q_group_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five thousand groups in one aggregate: suppliers by the order numbers (modulo 5,000) they deliver to."""
    links = Tables(spark, sf_dir).lineitem.select(
        F.col("l_suppkey").alias("uid"), F.concat(F.lit("G"), F.col("l_orderkey") % MANY_GROUPS).alias("group_uid"))
    words = membership_words(links, "uid", [f"G{i}" for i in range(MANY_GROUPS)], "group_uid")
    return words.select("uid", group_count(words).cast("int").alias("n_groups"), in_group(0).alias("in_first"), in_group(62).alias("in_63rd"),
                        in_group(63).alias("in_64th"), in_group(MANY_GROUPS - 1).alias("in_last"))


@register(
    "z_order_files",
    """SELECT k AS column_name, 256 AS files, true AS reads_half_at_most, (SELECT count(*) FROM lineitem) AS row_count
FROM (VALUES ('l_partkey'), ('l_suppkey'), ('l_shipdate')) AS t(k)""",
)
def q_z_order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem written along a Z-order of three columns: a filter for one value of any of them reads half of the files at most
    (about a quarter, where an order by one column alone reads all of them for the others)."""
    lineitem = Tables(spark, sf_dir).lineitem
    path, keys = scratch_path(spark, "z_order"), ["l_partkey", "l_suppkey", "l_shipdate"]
    z_order_for_write(lineitem, keys, 256).write.parquet(path)
    written = spark.read.parquet(path)
    rows = []
    for key in keys:
        value = lineitem.select(F.percentile_approx(key, 0.4)).first()[0]
        found = files_read(written, key, value, value).select(
            F.lit(key).alias("column_name"), F.col("files").cast("int").alias("files"), (F.col("hit") * 2 <= F.col("files")).alias("reads_half_at_most"))
        rows.append(found.withColumn("row_count", written.select(F.count(F.lit(1))).scalar()))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
