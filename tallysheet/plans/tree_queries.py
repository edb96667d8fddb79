"""Parent pointers, subtrees under renamed units, and simultaneous renames of columns (O-35, O-47, O-51, O-52)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.operators.schema_evolution import TEMPORARY, apply_plan, ordered_plan, schema_plan
from tallysheet.operators.tree import ancestor_closure, new_closure_rows, path_mismatches, paths_from_parents, with_descendants
from tallysheet.operators.hierarchy import flatten_hierarchy, level_columns
from tallysheet.plans.registry import register
from tallysheet.plans.warehouse_queries import _UNITS_SQL, org_levels, org_units
from tallysheet.sources.tables import Tables


def pointer_units(t: Tables) -> DataFrame:
    """The org-unit tree by parent ids alone: some customers without a known parent, some in and below cycles."""
    key = F.col("c_custkey")
    region = t.region.select(F.concat(F.lit("R"), F.col("r_regionkey")).alias("uid"), F.lit("").alias("parentid"))
    nation = t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("uid"), F.concat(F.lit("R"), F.col("n_regionkey")))
    parent = (F.when(key % 50 == 1, F.concat(F.lit("C"), key + 1)).when(key % 50 == 2, F.concat(F.lit("C"), key - 1))
              .when(key % 50 == 3, F.concat(F.lit("C"), key - 1)).when(key % 50 == 4, F.lit("X"))
              .when(key % 50 < 25, F.concat(F.lit("C"), key - 1)).otherwise(F.concat(F.lit("N"), F.col("c_nationkey"))))
    return region.union(nation).union(t.customer.select(F.concat(F.lit("C"), key), parent))


_POINTERS_SQL = """SELECT 'R' || r_regionkey AS uid, NULL AS parentid FROM region
 UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
 UNION ALL SELECT 'C' || c_custkey, CASE WHEN c_custkey % 50 = 1 THEN 'C' || (c_custkey + 1) WHEN c_custkey % 50 IN (2, 3) THEN 'C' || (c_custkey - 1)
   WHEN c_custkey % 50 = 4 THEN 'X' WHEN c_custkey % 50 < 25 THEN 'C' || (c_custkey - 1) ELSE 'N' || c_nationkey END FROM customer"""


@register(
    "parent_paths",
    f"""WITH RECURSIVE u AS ({_POINTERS_SQL}), p AS (
  SELECT uid, '/' || uid AS path, 1 AS level, 'ok' AS status FROM u WHERE parentid IS NULL
  UNION ALL SELECT uid, '/' || parentid || '/' || uid, 2, 'orphan' FROM u WHERE parentid IS NOT NULL AND parentid NOT IN (SELECT uid FROM u)
  UNION ALL SELECT u.uid, p.path || '/' || u.uid, p.level + 1, p.status FROM u JOIN p ON u.parentid = p.uid
)
SELECT uid, path, CAST(level AS INTEGER) AS level, coalesce(status, 'cycle') AS status FROM u LEFT JOIN p USING (uid)""",
)
def q_parent_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths by pointer doubling, with the units in, or below, a cycle and those without a known ancestor."""
    return paths_from_parents(pointer_units(Tables(spark, sf_dir)))


@register(
    "path_check",
    f"""WITH u AS ({_UNITS_SQL})
SELECT 'C' || c_custkey AS uid, '/R' || n_regionkey || '/N' || n_nationkey || '/C' || c_custkey AS stored_path,
       '/R' || ((n_regionkey + 1) % 5) || '/N' || n_nationkey || '/C' || c_custkey AS path, 'ok' AS status
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 7 = 3
UNION ALL SELECT 'N' || n_nationkey, '/R' || n_regionkey || '/N' || n_nationkey, '/R' || ((n_regionkey + 1) % 5) || '/N' || n_nationkey, 'ok'
FROM nation WHERE n_nationkey % 7 = 3""",
)
def q_path_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations whose parent says another region than the stored path: they and all below are listed."""
    t = Tables(spark, sf_dir)
    moved = F.when(F.col("n_nationkey") % 7 == 3, (F.col("n_regionkey") + 1) % 5).otherwise(F.col("n_regionkey"))
    region = t.region.select(F.concat(F.lit("R"), F.col("r_regionkey")).alias("uid"), F.lit(None).cast("string").alias("parentid"))
    nation = t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey")), F.concat(F.lit("R"), moved))
    customer = t.customer.select(F.concat(F.lit("C"), F.col("c_custkey")), F.concat(F.lit("N"), F.col("c_nationkey")))
    return path_mismatches(org_units(t), paths_from_parents(region.union(nation).union(customer)))


@register(
    "subtree_refresh",
    f"""WITH u AS (SELECT uid, CASE WHEN uid IN ('R1', 'N4', 'N7') THEN name || ' (new)' ELSE name END AS name, path FROM ({_UNITS_SQL})),
p AS (SELECT *, string_split(path, '/') AS parts FROM u)
SELECT p.uid, p.name, CAST(len(parts) - 1 AS INTEGER) AS level, parts[2] AS lvlRegion, r.name AS Region, coalesce(parts[3], '') AS lvlNation,
       coalesce(n.name, '') AS Nation, coalesce(parts[4], '') AS lvlCustomer, coalesce(CASE WHEN len(parts) = 4 THEN p.name END, '') AS Customer
FROM p JOIN u r ON r.uid = parts[2] LEFT JOIN u n ON n.uid = parts[3]
WHERE parts[2] = 'R1' OR parts[3] IN ('N4', 'N7')""",
)
def q_subtree_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One region and two nations get new names: they and all units below them are built anew, no others."""
    units = org_units(Tables(spark, sf_dir))
    # The closure of an earlier load knows all nations but Asia's, and these come with this load.
    early = ancestor_closure(units.where(~F.col("path").startswith("/R2")))
    closure = early.unionByName(new_closure_rows(early, units))
    changed = F.col("uid").isin("R1", "N4", "N7")
    units = units.withColumn("name", F.when(changed, F.concat("name", F.lit(" (new)"))).otherwise(F.col("name")))
    rows = with_descendants(units, units.where(changed), closure)
    return flatten_hierarchy(rows, level_columns(org_levels(spark)), lookup=units)


def renamed_nations(t: Tables) -> DataFrame:
    """Per region: one nation takes the next one's name and so on (a cycle); region 0 is a chain with a new name at its end."""
    following = t.nation.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("all"))
    rows = following.select("n_regionkey", "all", F.posexplode("all").alias("at", "n"))
    end = F.col("at") == F.size("all") - 1
    new = F.when(end & (F.col("n_regionkey") == 0), F.lit("ATLANTIS")).otherwise(
        F.get("all", F.when(end, 0).otherwise(F.col("at") + 1))["n_name"])
    return rows.select(F.col("n.n_nationkey").alias("n_nationkey"), F.concat(F.lit("N"), F.col("n.n_nationkey")).alias("uid"),
                       new.alias("name"), F.col("n.n_name").alias("previous_name"), F.lit("update").alias("change"))


def nation_counts(t: Tables) -> DataFrame:
    """Customers per market segment, a column per nation (25 names by definition)."""
    names = [r["n_name"] for r in t.nation.orderBy("n_nationkey").limit(100).collect()]
    joined = t.customer.join(F.broadcast(t.nation.limit(100)), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy(F.col("c_mktsegment").alias("uid")).pivot("n_name", names).count()


_NEW_NAMES_SQL = """SELECT n_nationkey, n_name AS old, replace(CASE WHEN n_regionkey = 0 AND lead(n_name) OVER w IS NULL THEN 'ATLANTIS'
  ELSE coalesce(lead(n_name) OVER w, first_value(n_name) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey)) END, ' ', '') AS new
FROM nation WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_nationkey)"""


@register(
    "rename_cycles",
    f"""WITH m AS ({_NEW_NAMES_SQL})
SELECT c_mktsegment AS uid, new AS nation, count(*) AS customers FROM customer JOIN m ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def q_rename_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that change names with each other at once keep their values under the new names."""
    t = Tables(spark, sf_dir)
    counts = nation_counts(t)
    wide = counts.select("uid", *[F.col(f"`{c}`").alias(c.replace(" ", "")) for c in counts.columns if c != "uid"])
    done = apply_plan(wide, schema_plan(renamed_nations(t), ["n_nationkey"]))
    return done.unpivot("uid", [c for c in done.columns if c != "uid"], "nation", "customers").where("customers IS NOT NULL")


@register(
    "rename_plan",
    """SELECT n_regionkey AS region, count(*) + (n_regionkey > 0)::INT AS statements, (n_regionkey > 0)::INT AS parked
FROM nation GROUP BY n_regionkey""",
)
def q_rename_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same renames as statements: a cycle takes one more, through a temporary name; none takes a name that is still held.

    A statement that would is counted in no region, so the counts would differ.
    """
    t = Tables(spark, sf_dir)
    plan = ordered_plan(schema_plan(renamed_nations(t), ["n_nationkey"]))
    later = (F.col("q.anchor") == F.col("p.column_name")) & (F.col("q.seq") > F.col("p.seq"))
    held = plan.alias("p").join(plan.alias("q"), later & ~F.col("p.column_name").endswith(TEMPORARY), "left_anti")
    plain = F.regexp_replace(F.col("anchor"), TEMPORARY + "$", "")
    region = t.nation.select(F.replace("n_name", F.lit(" "), F.lit("")).alias("name"), F.col("n_regionkey").alias("region"))
    return held.join(region, plain == F.col("name")).groupBy("region").agg(
        F.count(F.lit(1)).alias("statements"), F.sum(F.col("column_name").endswith(TEMPORARY).cast("int")).alias("parked"))
