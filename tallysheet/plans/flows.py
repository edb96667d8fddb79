"""The end-to-end jobs, composed from the operators.

1. ``stage_endpoint`` / ``stage_links``: landed metadata pages -> mapped rows ->
   staged table (sparse, version-guarded upsert with change tracking) or
   insert-only link table, committed as a new version
   (``plans.endpoints`` holds the configuration of every endpoint).
2. ``orgunit_dimension`` / ``category_dimension`` / ``dataelement_dimension`` /
   ``data_source_dimension``: pending staged rows -> warehouse dimension rows
   (plus the column plan for the org-unit levels).
3. ``load_data_values`` / ``start_data_value_stream``: per-unit data-value
   files since a mark (batch) or as they land (stream) -> staged fact table,
   rewriting only the periods a slice touches.
4. ``case_control_payloads``: survey form documents -> long report rows ->
   request bodies of at most 30 values.

Each returns DataFrames (lazy) or writes one new table version; nothing
passes through the driver except metadata lists and the next mark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.functions.casts import load_timestamp, truncate_seconds
from tallysheet.operators.changes import ChangeSpec, detect_changes, reset_changes, split_rejects
from tallysheet.operators.hierarchy import flatten_hierarchy, level_columns
from tallysheet.operators.incremental import group_members, is_empty, since_mark
from tallysheet.operators.skew import semi_join_keys
from tallysheet.operators.ordering import cluster_for_write
from tallysheet.operators.mapping import apply_mapping, malformed_cells, read_schema, spread_sections
from tallysheet.operators.presence import (
    PRESENT,
    fold_present,
    is_present,
    malformed_present,
    map_present,
    present_bits,
    upsert_present,
)
from tallysheet.operators.report import BandSpec, ReportConfig, fill_cast, form_report
from tallysheet.operators.schema_evolution import apply_plan, schema_plan
from tallysheet.operators.tree import new_closure_rows, with_descendants
from tallysheet.operators.unnest import explode_links
from tallysheet.operators.upsert import apply_changes, changed_rows, fold_sparse, insert_new, upsert
from tallysheet.operators.widen import membership_flags, pivot_options
from tallysheet.plans.endpoints import (
    DATA_VALUE_SPEC,
    DATA_VALUES,
    ENDPOINTS,
    LINKS,
    ORG_UNIT_LEVEL_SPEC,
    ORG_UNIT_SPEC,
    Endpoint,
    LinkSpec,
)
from tallysheet.sinks.partitioned_upsert import merge_into_partitions, read_partitioned
from tallysheet.sinks.payload import payload_chunks
from tallysheet.sinks.versioned import commit, read_latest
from tallysheet.session import bounded_rows, cut_lineage, path_exists
from tallysheet.sources.documents import (
    BAD_TEXT,
    FILE,
    POSITION,
    parse_documents,
    parsed_files,
    placed_items,
    read_documents,
    unit_files,
)
from tallysheet.sources.paging import check_complete
from tallysheet.sources.variants import variant_items


def _staged_schema(mapped: DataFrame, ep: Endpoint) -> T.StructType:
    schema = T.StructType(list(mapped.schema.fields))
    for col in ep.previous.values():
        schema = schema.add(col, T.StringType())
    return schema.add("change", T.StringType())


def fold_batch(mapped: DataFrame, ep: Endpoint) -> DataFrame:
    """One row per key: per column the newest present value, rows with a NULL key part left out.

    Newest by ``order_col``, then by the place the item was read from (file name, position), where ``mapped`` carries
    it: the order in which the documents would be applied one by one.  Without a place, a hash of
    the whole row breaks ties, so a rerun keeps the same document.
    """
    keys = list(ep.keys)
    mapped = split_rejects(mapped, keys)[0]
    version = [F.col(ep.order_col)] if ep.order_col in mapped.columns else []
    if FILE in mapped.columns:
        place = [F.col(FILE), F.col(POSITION)]
    else:
        place = [F.xxhash64(*[F.col(f"`{c}`") for c in mapped.columns])]
    batch = mapped.withColumn("_seq", F.struct(*version, *place)).drop(FILE, POSITION)
    return fold_sparse(batch, keys, "_seq")


def stage_rows(current: DataFrame, mapped: DataFrame, ep: Endpoint) -> DataFrame:
    """Fold the batch per key and column (newest present value wins) and upsert it with change tracking.

    A partial document keeps the other columns of the documents before it, as
    if they had come one by one: documents in the order of ``order_col``, equal ones in the order of their files, give
    the same table however they are split into batches (a stored value loses against an equally old one that comes later); a stored
    value newer than the incoming one is kept (late or re-pulled documents never
    regress a value).  Rows with a NULL key part never enter (``rejected_rows``).
    """
    return _stage_folded(current, fold_batch(mapped, ep), ep)


def _stage_folded(current: DataFrame, batch: DataFrame, ep: Endpoint) -> DataFrame:
    version = ep.order_col if ep.order_col in batch.columns else None
    spec = ChangeSpec(keys=list(ep.keys), tracked=list(ep.tracked), previous=dict(ep.previous), version_col=version)
    return detect_changes(current, batch, spec, sparse=True)


def rejected_rows(mapped: DataFrame, ep: Endpoint) -> DataFrame:
    """Mapped rows that cannot be staged, with a ``reason``: a missing key part, or a missing required column."""
    return split_rejects(mapped, [*ep.keys, *[c for c in ep.required if c not in ep.keys]])[1]


def mapped_items(placed: DataFrame, spec: Mapping, source_url: str, carry: Sequence[str] = ()) -> DataFrame:
    """Mapped rows of :func:`placed_items` with their place, and ``reason`` / ``bad`` where one cannot be staged.

    ``bad`` is the unreadable document, or the cells that hold no value of their type.
    """
    cells = F.array_join(malformed_cells(spec, placed.schema), ", ")
    marked = placed.withColumn("_cells", cells)
    reason = F.when(F.col(BAD_TEXT).isNotNull(), F.lit("unreadable document")).when(
        F.length("_cells") > 0, F.concat(F.lit("malformed "), F.col("_cells")))
    marked = marked.withColumn("reason", reason)
    return apply_mapping(marked, spec, source_url, carry=[*carry, FILE, POSITION, BAD_TEXT, "reason"])


def _split_mapped(mapped: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows to stage, and the others as ``(reason, row)``, the row as JSON text."""
    whole, missing = split_rejects(mapped.where("reason IS NULL").drop("reason"), required)
    broken = mapped.where("reason IS NOT NULL")
    document = F.to_json(F.struct(F.col(FILE).alias("file"), F.col(BAD_TEXT).alias("text")))
    rejects = broken.select("reason", F.when(F.col(BAD_TEXT).isNotNull(), document).otherwise(_row_text(broken)).alias("row"))
    return whole.drop(BAD_TEXT), rejects.unionByName(missing.select("reason", _row_text(missing).alias("row")))


def _row_text(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in ("reason", FILE, POSITION, BAD_TEXT)]))


def _keep_rejects(rejects: DataFrame, store: str, table: str) -> None:
    """Adds ``(reason, row)`` to the table's rejects, each once: a reload or a replayed batch adds none."""
    spark, path = rejects.sparkSession, f"{store}/{table}_rejects"
    fresh = rejects.select("reason", "row").distinct()
    if path_exists(spark, path):
        fresh = fresh.join(spark.read.schema("reason string, row string").parquet(path), ["reason", "row"], "left_anti")
    fresh = cut_lineage(fresh)  # the folder it was compared with is about to grow
    if not is_empty(fresh):
        fresh.write.mode("append").parquet(path)


def stage_endpoint(spark: SparkSession, landed_dir: str, ep: Endpoint, store: str, source_url: str,
                   multi_line: bool = True, on_bad: str = "fail", complete: bool = False) -> int:
    """Landed pages of one endpoint -> new version of its staging table; returns the version.

    With ``complete`` the pages' own pagers must say that none is missing, came twice or shifted (``sources.paging``),
    or the load fails before anything is written.

    Rows without a key, with a cell that is no value of its column's type, and new rows without a required
    column go to ``<table>_rejects``; a document that cannot be read fails the
    load, or goes there too with ``on_bad="skip"``.  The pages are parsed once.
    """
    if complete:
        check_complete(spark, landed_dir, ep.list_key, multi_line)
    schema = read_schema(ep.spec)
    parsed = parsed_files(spark, landed_dir, ep.list_key, schema, multi_line)
    mapped = cut_lineage(mapped_items(placed_items(parsed, on_bad=on_bad), ep.spec, source_url))
    rows, rejects = _split_mapped(mapped, ep.keys)
    path = f"{store}/{ep.table}"
    current = read_latest(spark, path, _staged_schema(rows.drop(FILE, POSITION), ep))
    batch, incomplete = _without_incomplete(current, fold_batch(rows, ep), ep)
    _keep_rejects(rejects.unionByName(incomplete), store, ep.table)
    return commit(_stage_folded(current, batch, ep), path)


def stage_present(spark: SparkSession, landed_dir: str, ep: Endpoint, store: str, source_url: str,
                  multi_line: bool = True, on_bad: str = "fail") -> int:
    """As :func:`stage_endpoint`, by the keys that documents have: a key with null overwrites, an absent key does not.

    A document with null for a required column goes to the rejects.
    The staged table has a ``present`` column (see ``operators.presence``); a table staged before without it counts
    its non-null columns as given.
    """
    bits = present_bits(ep.spec)
    placed = variant_items(spark, landed_dir, ep.list_key, multi_line, on_bad=on_bad)
    cells = F.array_join(malformed_present(ep.spec), ", ")
    reason = F.when(F.col(BAD_TEXT).isNotNull(), F.lit("unreadable document")).when(
        F.length(cells) > 0, F.concat(F.lit("malformed "), cells))
    mapped = map_present(placed.withColumn("reason", reason), ep.spec, source_url, carry=[FILE, POSITION, BAD_TEXT, "reason"])
    # A null for a required column is no value of it: refused document by document, so batches may be cut anywhere.
    emptied = F.array_compact(F.array(*[F.when(is_present(c, bits) & F.col(f"`{c}`").isNull(), F.lit(c)) for c in ep.required if c in bits]))
    emptied = F.when(F.size(emptied) > 0, F.concat(F.lit("null for required "), F.array_join(emptied, ", ")))
    mapped = mapped.withColumn("reason", F.coalesce("reason", emptied))
    rows, rejects = _split_mapped(cut_lineage(mapped), ep.keys)
    seq = F.struct(*([F.col(ep.order_col)] if ep.order_col in rows.columns else []), F.col(FILE), F.col(POSITION))
    batch = fold_present(rows.withColumn("_seq", seq).drop(FILE, POSITION), list(ep.keys), "_seq", bits)
    path = f"{store}/{ep.table}"
    current = read_latest(spark, path, _staged_schema(batch, ep))
    given = reduce(lambda a, c: a.bitwiseOR(F.when(F.col(f"`{c}`").isNotNull(), F.lit(bits[c])).otherwise(0).cast("long")),
                   [c for c in bits if c in current.columns], F.lit(0).cast("long"))
    current = current.withColumn(PRESENT, F.coalesce(PRESENT, given))
    batch, incomplete = _without_incomplete(current, batch, ep)
    _keep_rejects(rejects.unionByName(incomplete), store, ep.table)
    version = ep.order_col if ep.order_col in batch.columns else None
    spec = ChangeSpec(keys=list(ep.keys), tracked=list(ep.tracked), previous=dict(ep.previous), version_col=version)
    return commit(upsert_present(current, batch, spec, bits), path)


def _without_incomplete(current: DataFrame, batch: DataFrame, ep: Endpoint) -> tuple[DataFrame, DataFrame]:
    """``batch`` without the new keys that lack a required column, and those as ``(reason, row)``.

    A partial document of a stored key is fine: the stored row has the rest.
    """
    required = [c for c in ep.required if c in batch.columns]
    stored = current.select(*ep.keys).withColumn("_stored", F.lit(True))
    known = batch.join(stored, list(ep.keys), "left")
    lacks = reduce(lambda a, c: a | F.col(f"`{c}`").isNull(), required, F.lit(False)) & F.col("_stored").isNull()
    reason, row = split_rejects(batch, required)[1], _row_text(batch)
    incomplete = reason.join(stored, list(ep.keys), "left_anti").select("reason", row.alias("row"))
    return known.where(~lacks).drop("_stored"), incomplete


def stage_links(spark: SparkSession, landed_dir: str, link: LinkSpec, store: str, source_url: str,
                multi_line: bool = True) -> int:
    """M:N link table from the child lists of landed pages (insert-only); returns the version.

    New links are pending (``change``) until an export.  A link without one of its ids goes to ``<table>_rejects``.
    """
    schema = read_schema(link.parent_spec).add(link.child_key, T.ArrayType(read_schema(link.child_spec)), True)
    docs = read_documents(spark, landed_dir, link.list_key, schema, multi_line=multi_line)
    links = cut_lineage(explode_links(docs, link.parent_spec, link.child_key, link.child_spec, source_url))
    links, missing = split_rejects(links, link.keys)
    _keep_rejects(missing.select("reason", _row_text(missing).alias("row")), store, link.table)
    path = f"{store}/{link.table}"
    links = links.withColumn("change", F.lit("insert"))
    current = read_latest(spark, path, links.schema)
    return commit(insert_new(current, links, list(link.keys)), path)


def data_source_rows(spark: SparkSession, sources: DataFrame | None, url: str, title: str,
                     description: str = "") -> DataFrame:
    """The data-source staging table with its seed row added once (insert-only, keyed on ``id``)."""
    seed = spark.createDataFrame(source_row(url, title, description), "id string, title string, url string, description string")
    seed = seed.withColumn("change", F.lit("insert"))
    if sources is None:
        return seed
    return insert_new(sources, seed, ["id"])


def data_source_dimension(warehouse: DataFrame, staged: DataFrame) -> DataFrame:
    """Warehouse data-source table after applying the pending staged rows (keyed on ``id``)."""
    return apply_changes(warehouse, changed_rows(staged), ["id"])


def orgunit_dimension(units: DataFrame, levels: DataFrame, plan_anchor: str = "lastupdated",
                      closure: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(column plan, warehouse rows) for the org-unit dimension.

    Rows: the pending units, flattened against the full unit table, without
    ``change``/``path``/``parentid``, ``lastupdated`` truncated to seconds.  With the ``closure`` of the units'
    inner paths also all units below a pending one, whose rows show its name.
    """
    plan = schema_plan(levels, ["level", "uid"], anchor=plan_anchor)
    pending = changed_rows(units)
    if closure is not None:
        pending = with_descendants(units, pending, closure, source="sourceid")
    flat = flatten_hierarchy(pending, level_columns(levels), keep=["sourceid", "lastupdated"], lookup=units,
                             source="sourceid")
    return plan, flat.withColumn("lastupdated", truncate_seconds(F.col("lastupdated")))


def extend_closure(spark: SparkSession, store: str, units: DataFrame) -> DataFrame:
    """The store's closure of inner paths, with those of ``units`` added; only new ones are written."""
    path = f"{store}/organisationunit_closure"
    stored = spark.read.schema("sourceid string, ancestor string, inner string").parquet(path) if path_exists(spark, path) else None
    fresh = cut_lineage(new_closure_rows(stored, units, source="sourceid"))
    if stored is None or not is_empty(fresh):
        fresh.select("sourceid", "ancestor", "inner").write.mode("append").parquet(path)
    return spark.read.schema("sourceid string, ancestor string, inner string").parquet(path)


def category_dimension(combos: DataFrame, combo_options: DataFrame, options: DataFrame,
                       category_options: DataFrame, categories: DataFrame, as_of: str,
                       changed_only: str | None = "options") -> DataFrame:
    """Category dimension: per combo, option uid / name under each category's columns.

    Inputs are staged tables: combos (uid, name), combo_options
    (category_option_combo_id, category_option_id), options (uid, name, sourceid,
    change), category_options (category_id, categoryoption_id), categories (uid, name).
    ``changed_only`` picks the input whose pending rows drive the export
    ("options", "combos", "categories"; ``None`` exports everything): the combos that hold one of them are exported, each
    whole, from all its options.  When
    every input carries ``sourceid`` the joins and the pivot match on it as well,
    so two sources with colliding uids never mix; without it, uids are unique.
    """
    by_source = all("sourceid" in df.columns for df in (combos, combo_options, options, category_options, categories))
    src = ["sourceid"] if by_source else []
    if changed_only is not None:
        pending = changed_rows({"combos": combos, "options": options, "categories": categories}[changed_only])
        if changed_only == "categories":
            pending = options_of(category_options, pending, src)
        given = (pending, None) if changed_only == "combos" else (None, pending)
        combos = combos.join(touched_combos(combo_options, *given, src), ["uid", *src], "left_semi")
    links = (
        combos.select(F.col("uid").alias("coc"), F.col("name").alias("coc_name"), *src)
        .join(combo_options.select(F.col("category_option_combo_id").alias("coc"),
                                   F.col("category_option_id").alias("opt"), *src), ["coc", *src])
        .join(options.select(F.col("uid").alias("opt"), F.col("name").alias("opt_name"),
                             *(src or ["sourceid"])), ["opt", *src])
        .join(category_options.select(F.col("categoryoption_id").alias("opt"), F.col("category_id").alias("cat"), *src),
              ["opt", *src])
        .join(categories.select(F.col("uid").alias("cat"), F.col("name").alias("cat_name"), *src),
              ["cat", *src])
    )
    wide = pivot_options(links, ["coc", *src], column_names(categories), "cat", "opt", "opt_name", "opt",
                         carry=["coc_name"] if by_source else ["coc_name", "sourceid"])
    return wide.select(
        F.col("coc").alias("categoryoptioncomboid"),
        F.col("coc_name").alias("categoryoptioncomboname"),
        "sourceid",
        load_timestamp(as_of).alias("lastupdated"),
        *[F.col(f"`{c}`") for c in wide.columns if c not in ("coc", "coc_name", "sourceid")],
    )


def options_of(category_options: DataFrame, categories: DataFrame, src: Sequence[str] = ()) -> DataFrame:
    """``(uid, *src)``: the options that belong to one of ``categories``."""
    chosen = categories.select(F.col("uid").alias("category_id"), *src)
    return category_options.join(chosen, ["category_id", *src], "left_semi").select(F.col("categoryoption_id").alias("uid"), *src)


def touched_combos(combo_options: DataFrame, combos: DataFrame | None, options: DataFrame | None,
                   src: Sequence[str] = ()) -> DataFrame:
    """``(uid, *src)``: the given combos, and those that hold one of the given options."""
    parts = [] if combos is None else [combos.select("uid", *src)]
    if options is not None:
        held = combo_options.join(options.select(F.col("uid").alias("category_option_id"), *src), ["category_option_id", *src], "left_semi")
        parts.append(held.select(F.col("category_option_combo_id").alias("uid"), *src))
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def column_names(metadata: DataFrame) -> list[tuple[str, str]]:
    """(uid, name) of a metadata table, one name per uid (two sources may both have it), in uid order."""
    names = metadata.groupBy("uid").agg(F.max("name").alias("name")).where("uid is not null and name is not null")
    return [(r["uid"], r["name"]) for r in bounded_rows(names.orderBy("uid"), "metadata columns")]


def dataelement_dimension(elements: DataFrame, element_groups: DataFrame, groups: DataFrame, as_of: str) -> DataFrame:
    """Data-element dimension: ``'t'`` under each group's uid and name columns (full export).

    When both inputs carry ``sourceid``, a link flags elements of its own source only.
    """
    src = ["sourceid"] if "sourceid" in element_groups.columns and "sourceid" in elements.columns else []
    links = element_groups.select(F.col("dataelement_id").alias("uid"), *src, F.col("group_id").alias("group_uid"))
    flags = membership_flags(links, ["uid", *src], column_names(groups), "group_uid")
    return elements.select("uid", "name", "sourceid").join(flags, ["uid", *src]).select(
        "uid", "name", "sourceid", load_timestamp(as_of).alias("lastupdated"),
        *[F.col(f"`{c}`") for c in flags.columns if c not in ("uid", *src)],
    )


def category_plan(categories: DataFrame, anchor: str = "lastupdated") -> DataFrame:
    """Column plan of the category dimension: a uid and a name column per pending category."""
    return schema_plan(categories, ["uid"], anchor=anchor)


def dataelement_plan(groups: DataFrame, anchor: str = "lastupdated") -> DataFrame:
    """Column plan of the data-element dimension: a uid and a name column per pending group."""
    return schema_plan(groups, ["uid"], anchor=anchor)


def load_dimension(spark: SparkSession, path: str, rows: DataFrame, plan: DataFrame | None, keys: Sequence[str],
                   cluster_by: Sequence[str] = ()) -> int:
    """Warehouse load of one dimension: evolve the stored table by the plan, upsert the rows, commit a version.

    New columns are ``''`` in rows that the load does not carry; the table is written
    clustered by ``cluster_by`` (default: the keys).  Read it with ``read_latest``.
    """
    stored = read_latest(spark, path)
    if stored is None:
        table = rows
    else:
        evolved = stored if plan is None else apply_plan(stored, plan)
        table = upsert(evolved, rows, list(keys))
        filled = [c for c in table.columns if dict(table.dtypes)[c] == "string" and c not in keys]
        table = table.fillna("", subset=[f"`{c}`" for c in filled])
    return commit(cluster_for_write(table, list(cluster_by or keys)), path)


def _pending(*snapshots: DataFrame) -> bool:
    return any(not is_empty(changed_rows(df)) for df in snapshots)


def _pending_links(links: DataFrame) -> DataFrame:
    """Links that no export has taken yet; all of them in a table written before links had a status."""
    return changed_rows(links) if "change" in links.columns else links


def _reset_exported(spark: SparkSession, store: str, snapshots: Mapping[str, DataFrame],
                    keys: Sequence[str] = ("uid", "sourceid")) -> None:
    """Reset exactly the rows that were pending in the exported snapshots; rows that changed since stay pending."""
    for table, snapshot in snapshots.items():
        path = f"{store}/{table}"
        commit(reset_changes(read_latest(spark, path), keys, changed_rows(snapshot)), path)


def _reset_links(spark: SparkSession, store: str, snapshots: Mapping[str, DataFrame]) -> None:
    for table, snapshot in snapshots.items():
        if "change" not in snapshot.columns:  # from now on with a status, everything in it exported
            commit(read_latest(spark, f"{store}/{table}").withColumn("change", F.lit("")), f"{store}/{table}")
        elif _pending(snapshot):
            _reset_exported(spark, store, {table: snapshot}, LINKS[table].keys)


def export_orgunits(spark: SparkSession, store: str, warehouse: str) -> int | None:
    """One warehouse load of the org-unit dimension: plan, flatten, load, then reset what was exported.

    A renamed (or newly known) unit takes its whole subtree along, found through the closure of inner paths, to which
    the pending units' paths are added first; no other row is built.  Works on one snapshot of the staged tables.  Returns the warehouse version (None: nothing pending).
    """
    units, levels = read_latest(spark, f"{store}/organisationunit"), read_latest(spark, f"{store}/orgunitlevel")
    if not _pending(units, levels):
        return None
    closure_path = f"{store}/organisationunit_closure"
    closure = extend_closure(spark, store, changed_rows(units) if path_exists(spark, closure_path) else units)
    plan, rows = orgunit_dimension(units, levels, closure=closure)
    version = load_dimension(spark, f"{warehouse}/organisationunit", rows, plan, ["uid", "sourceid"])
    _reset_exported(spark, store, {"organisationunit": units, "orgunitlevel": levels})
    return version


def export_categories(spark: SparkSession, store: str, warehouse: str, as_of: str) -> int | None:
    """One warehouse load of the category dimension.

    A pending category changes columns, so every combo is exported; else those are that are pending themselves, hold a pending
    option, or have a new link (to an option, or from one to a category).  A combo's row is always built from all its options.
    """
    names = ["categoryoptioncombo", "categoryoptioncombo_categoryoptions", "dataelementcategoryoption",
             "dataelementcategory_categoryoption", "dataelementcategory"]
    combos, combo_options, options, category_options, categories = (read_latest(spark, f"{store}/{n}") for n in names)
    new_links, new_members = _pending_links(combo_options), _pending_links(category_options)
    if not _pending(combos, options, categories) and is_empty(new_links) and is_empty(new_members):
        return None
    if _pending(categories):
        exported = combos
    else:
        src = ["sourceid"]
        changed = changed_rows(combos).select("uid", *src).unionByName(
            new_links.select(F.col("category_option_combo_id").alias("uid"), *src))
        held = changed_rows(options).select("uid", *src).unionByName(
            new_members.select(F.col("categoryoption_id").alias("uid"), *src))
        exported = combos.join(touched_combos(combo_options, changed, held, src), ["uid", *src], "left_semi")
    rows = category_dimension(exported, combo_options, options, category_options, categories, as_of, changed_only=None)
    version = load_dimension(spark, f"{warehouse}/category", rows, category_plan(categories),
                             ["categoryoptioncomboid", "sourceid"])
    _reset_exported(spark, store, {names[0]: combos, names[2]: options, names[4]: categories})
    _reset_links(spark, store, {names[1]: combo_options, names[3]: category_options})
    return version


def export_dataelements(spark: SparkSession, store: str, warehouse: str, as_of: str) -> int | None:
    """One warehouse load of the data-element dimension: a full export, whenever an element, a group or a link is pending.

    Links are never changed or removed, so a run without any of these would write the same rows again.
    """
    elements, links, groups = (read_latest(spark, f"{store}/{n}")
                               for n in ("dataelement", "dataelement_dataelementgroup", "dataelementgroup"))
    if not _pending(elements, groups) and is_empty(_pending_links(links)):
        return None
    rows = dataelement_dimension(elements, links, groups, as_of)
    version = load_dimension(spark, f"{warehouse}/dataelement", rows, dataelement_plan(groups), ["uid", "sourceid"])
    _reset_exported(spark, store, {"dataelement": elements, "dataelementgroup": groups})
    _reset_links(spark, store, {"dataelement_dataelementgroup": links})
    return version


def export_data_sources(spark: SparkSession, store: str, warehouse: str) -> int | None:
    """One warehouse load of the data-source table: pending rows are inserted or overwrite their key."""
    staged = read_latest(spark, f"{store}/data_source")
    if not _pending(staged):
        return None
    path = f"{warehouse}/data_source"
    stored = read_latest(spark, path, staged.drop("change").schema)
    version = commit(cluster_for_write(data_source_dimension(stored, staged), ["id"]), path)
    _reset_exported(spark, store, {"data_source": staged}, ["id"])
    return version


def load_data_values(spark: SparkSession, landed_dir: str, store: str, source_url: str, mark: str,
                     group_links: DataFrame | None = None, groups: Sequence[str] = (),
                     layout: str = "file", leaf_units: DataFrame | None = None) -> object:
    """Fact ingest since ``mark`` into ``<store>/datavalue`` (partitioned by period); returns the next mark.

    Only the periods the slice touches are read and rewritten; the period is
    part of the key, so no other partition can change.
    """
    item = read_schema(DATA_VALUE_SPEC)
    parsed = unit_files(spark, landed_dir, "dataValues", item, "_unit", layout=layout, multi_line=True)
    if leaf_units is not None:
        # Only files of known leaf units count (a unit id is the file or folder name).
        parsed = semi_join_keys(parsed, leaf_units.select(F.col("uid").alias("_unit")).distinct(), ["_unit"])
    mapped = mapped_items(placed_items(parsed, on_bad="fail"), DATA_VALUE_SPEC, source_url)
    # What cannot be staged is kept aside; of the rest only what is since the mark.
    since = F.col("lastupdated").isNull() | F.col("reason").isNotNull() | (F.col("lastupdated") >= F.lit(mark).cast("timestamp_ntz"))
    # Parsed once: rejects, the guard, the partition list, the merge and the next mark read the staged slice.
    mapped = cut_lineage(mapped.where(since))
    # A value without a time can neither be ordered nor marked: it is kept aside, not dropped.
    fresh, rejects = _split_mapped(mapped, [*DATA_VALUES.keys, *DATA_VALUES.required])
    _keep_rejects(rejects, store, "datavalue")
    fresh = since_mark(fresh, "lastupdated", mark)
    if group_links is not None and groups:
        fresh = cut_lineage(group_members(fresh, group_links, groups, "dataelementid", "dataelement_id", "group_id"))
    if is_empty(fresh):
        return mark  # nothing new: no write, the mark stays
    merge_into_partitions(
        spark, f"{store}/datavalue", fresh, ["period"], lambda cur, new: stage_rows(cur, new, DATA_VALUES),
        _data_value_schema(spark),
    )
    top = fresh.agg(F.max("lastupdated")).first()[0]  # one value: the next mark
    return top if top is not None else mark


def start_data_value_stream(spark: SparkSession, landed_dir: str, store: str, source_url: str, checkpoint: str,
                            max_files_per_trigger: int | None = None, available_now: bool = True):
    """The fact load as a stream: each new landed file is part of the next slice.

    The stream checkpoint replaces the stored mark; every micro-batch is
    upserted (with change tracking) into only the periods it touches, so a
    replayed batch leaves the same table.
    """
    item = read_schema(DATA_VALUE_SPEC)
    reader = spark.readStream.schema("value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.text(landed_dir, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"),
        parse_documents(F.col("value"), "dataValues", item).alias("items"))
    stream = placed_items(stream, on_bad="fail")
    path = f"{store}/datavalue"

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        # Parsed once per batch: rejects, the partition list and the merge read the staged slice.
        mapped = cut_lineage(mapped_items(batch, DATA_VALUE_SPEC, source_url))
        rows, rejects = _split_mapped(mapped, [*DATA_VALUES.keys, *DATA_VALUES.required])
        _keep_rejects(rejects, store, "datavalue")
        merge_into_partitions(spark, path, rows, ["period"], lambda cur, new: stage_rows(cur, new, DATA_VALUES),
                              _data_value_schema(spark))

    writer = stream.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _data_value_schema(spark: SparkSession) -> T.StructType:
    empty = apply_mapping(spark.createDataFrame([], read_schema(DATA_VALUE_SPEC)), DATA_VALUE_SPEC, "")
    return _staged_schema(empty, DATA_VALUES)


def read_data_values(spark: SparkSession, store: str) -> DataFrame:
    return read_partitioned(spark, f"{store}/datavalue", _data_value_schema(spark))


def case_control_payloads(forms: Mapping[str, DataFrame], config: ReportConfig, orgunits: DataFrame,
                          spec: BandSpec = BandSpec(), size: int = 30,
                          sections: Sequence[str] = ("s1", "s2", "s3", "s4", "s6", "s7", "s5")) -> DataFrame:
    """Form documents (``value`` array of section structs) -> request bodies of at most ``size`` values.

    The values of all report groups make one ordered list that is cut into
    chunks, so every body but the last is full.  A section field with the tag's
    name beats the tag.
    """
    spread = [
        spread_sections(doc.select(F.explode("value").alias("r")).select("r.*"), list(sections), ("SOURCE_FORM", F.lit(name)))
        for name, doc in forms.items()
    ]
    rows = fill_cast(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), spread))
    report = form_report(rows, config, orgunits, spec)
    return payload_chunks(
        report, ["period", "orgUnit", "dataElement", "categoryOptionCombo", "value"],
        ["categoryOptionCombo", "attributeOptionCombo", "period", "orgUnit", "dataElement", "value"], size=size,
    )


def source_row(source_id_url: str, title: str, description: str = "") -> list[tuple]:
    """The seed row of the data-source table (id = MD5 of the url)."""
    import hashlib

    return [(hashlib.md5(source_id_url.encode()).hexdigest(), title, source_id_url, description)]


__all__ = [
    "DATA_VALUE_SPEC",
    "ENDPOINTS",
    "LINKS",
    "Endpoint",
    "LinkSpec",
    "ORG_UNIT_LEVEL_SPEC",
    "ORG_UNIT_SPEC",
    "case_control_payloads",
    "category_dimension",
    "category_plan",
    "data_source_dimension",
    "data_source_rows",
    "dataelement_dimension",
    "dataelement_plan",
    "export_categories",
    "export_data_sources",
    "export_dataelements",
    "export_orgunits",
    "load_dimension",
    "rejected_rows",
    "load_data_values",
    "read_data_values",
    "start_data_value_stream",
    "orgunit_dimension",
    "source_row",
    "stage_endpoint",
    "stage_links",
]
