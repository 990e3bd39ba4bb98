"""The registered queries: one per operator, each over whole tables of the data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, hashing, text
from tidemark.model import DELETE, FLOW_BY_PRODUCT, INSERT, MOVEMENTS, UPDATE, Cut
from tidemark.operators import history, keys, marts, merge, normalize, quality, ranking
from tidemark.plans import demo, pipeline, reports
from tidemark.sources import cuts as source
from tidemark.sources.scratch import scratch_path
from tidemark.sources.store import Store, cut_slice
from tidemark.streaming.cuts import process_manifest, stream_cuts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROW = ["_cut_label", "_row_num"]


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# -- sources and landing ----------------------------------------------------------------
EVENTS_SPEC_COLUMNS = ("event_id", "user_id", "event_type", "value")


@query("scan_cut")
def scan_cut(spark: SparkSession, sf: str) -> DataFrame:
    """A cut's declared columns, read back from the file a source delivered."""
    cut = demo.write_cuts(spark, sf)[0]
    return source.scan_cut(spark, cut.path, MOVEMENTS).select(*MOVEMENTS.source_columns)


@query("land_lineage")
def land_lineage(spark: SparkSession, sf: str) -> DataFrame:
    scanned = demo.table(spark, sf, "events").select(
        *EVENTS_SPEC_COLUMNS, F.col("_metadata.file_name").alias("_source_file"),
        source.row_number_in_file().alias("_row_num"))
    return source.with_lineage(scanned, demo.CUTS[0]).drop("_row_num", "_load_ts")


@query("land_row_num")
def land_row_num(spark: SparkSession, sf: str) -> DataFrame:
    return demo.table(spark, sf, "orders").select(
        "o_orderkey", source.row_number_in_file().alias("row_num"))


@query("land_idempotent")
def land_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per slice after landing all cuts and then the second one again."""
    store = Store(spark, scratch_path(spark, "store"), MOVEMENTS)
    cuts = demo.write_cuts(spark, sf)
    for cut in [*cuts, cuts[1]]:
        pipeline.land(spark, store, cut)
    return store.raw().groupBy("_cut_label", "_cut_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("_row_num").alias("max_row_num"))


@query("landed_count")
def landed_count(spark: SparkSession, sf: str) -> DataFrame:
    return demo.movements_raw(spark, sf).groupBy("_cut_label").agg(
        F.count(F.lit(1)).alias("source_rows"))


@query("manifest")
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Cuts in date order with their rows."""
    rows = demo.movements_raw(spark, sf).groupBy("_cut_date").agg(
        F.count(F.lit(1)).alias("n_rows")).withColumnRenamed("_cut_date", "cut_date")
    return source.manifest(spark, demo.CUTS).join(rows, "cut_date", "left").orderBy("cut_date")


def _fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    rows = demo.movements_raw(spark, sf)
    return rows.groupBy("_cut_label", "_cut_date").agg(
        *source.fingerprint_columns(MOVEMENTS)).select(
        F.col("_cut_label").alias("cut_label"), F.col("_cut_date").alias("cut_date"),
        "source_rows",
        source.fingerprint_text(F.col("source_rows"), F.col("checksum")).alias("fingerprint"))


@query("cut_fingerprint")
def cut_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return _fingerprints(spark, sf)


@query("pending_cuts")
def pending_cuts(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger: T as it is, T1 with other content, T2 not at all."""
    found = _fingerprints(spark, sf)
    ledger = found.filter("cut_label <> 'T2'").withColumn(
        "fingerprint", F.when(F.col("cut_label") == "T1", "other").otherwise(F.col("fingerprint")))
    return source.pending_cuts(found, ledger).select("cut_label", "cut_date", "source_rows")


@query("order_guard")
def order_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Cuts that may not be processed once T1 has been."""
    found = _fingerprints(spark, sf)
    return source.late_cuts(found, found.filter("cut_label <> 'T2'")).select(
        "cut_label", "cut_date")


@query("single_cut")
def single_cut(spark: SparkSession, sf: str) -> DataFrame:
    """The live state after one ad-hoc cut."""
    store = Store(spark, scratch_path(spark, "store"), MOVEMENTS)
    pipeline.process_cut(spark, store, demo.write_cuts(spark, sf)[1])
    return store.live().select("movement_key", "attr_hash", "valid_from", "cut_label")


@query("ledger_append")
def ledger_append(spark: SparkSession, sf: str) -> DataFrame:
    return demo.published(spark, sf).ledger().select("commit", "cut_label", "cut_date", "status")


@query("run_metrics")
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return demo.published(spark, sf).ledger().select(
        "cut_label", "cut_date", "source_rows", "rows_valid", "rows_quarantined",
        "rows_new", "rows_changed", "rows_deleted", "rows_unchanged", "status")


@query("history_publish")
def history_publish(spark: SparkSession, sf: str) -> DataFrame:
    """The published history, as a reader of the store sees it."""
    return _history_columns(demo.published(spark, sf).history())


@query("rebuild")
def rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """The history of a store rebuilt from zero in one pass."""
    store = Store(spark, scratch_path(spark, "store"), MOVEMENTS)
    pipeline.rebuild(spark, store, demo.write_cuts(spark, sf))
    return _history_columns(store.history())


@query("stream_cuts")
def stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events per cut after a streaming run over the manifest."""
    store = Store(spark, scratch_path(spark, "store"), MOVEMENTS)
    folder = scratch_path(spark, "manifest")
    source.manifest(spark, demo.write_cuts(spark, sf)).write.json(folder)
    stream_cuts(spark, store, folder, scratch_path(spark, "stream")).awaitTermination()
    return marts.change_counts(store.change_log())


@query("stream_replayed")
def stream_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Events per cut when the first cut comes alone, all three with the next batch, that batch
    once more after a break, and at last other content for the first date, too late."""
    store = Store(spark, scratch_path(spark, "store"), MOVEMENTS)
    cuts = demo.write_cuts(spark, sf)
    late = Cut("late", cuts[2].path, cuts[0].cut_date)
    for batch, wanted in ((0, cuts[:1]), (1, cuts), (1, cuts), (2, [late])):
        process_manifest(spark, store, source.manifest(spark, wanted), "stream", batch)
    return marts.change_counts(store.change_log())


@query("run_twice")
def run_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The run records after all cuts were run, and then all of them again."""
    store = Store(spark, scratch_path(spark, "store"), MOVEMENTS)
    cuts = demo.write_cuts(spark, sf)
    for _ in range(2):
        pipeline.run_cuts(spark, store, cuts)
    return store.records().select("commit", "cut_label", "cut_date", "status")


# -- normalisation ----------------------------------------------------------------------
@query("norm_text")
def norm_text(spark: SparkSession, sf: str) -> DataFrame:
    return demo.movements_raw(spark, sf).select(
        *ROW, *[text.canonical(F.col(c)).alias(c) for c in ("id_cliente", "product", "fund")])


@query("norm_optional")
def norm_optional(spark: SparkSession, sf: str) -> DataFrame:
    return demo.movements_raw(spark, sf).select(
        *ROW, *[text.optional(F.col(c)).alias(c) for c in ("description", "commercial_name")])


@query("norm_type")
def norm_type(spark: SparkSession, sf: str) -> DataFrame:
    return demo.movements_raw(spark, sf).select(
        *ROW, F.col("type").alias("type_raw"),
        text.mapped(F.col("type"), _key("type").mapping).alias("type"))


@query("norm_date")
def norm_date(spark: SparkSession, sf: str) -> DataFrame:
    return demo.movements_raw(spark, sf).select(
        *ROW, F.col("date").alias("date_raw"),
        dates.parsed_date(F.col("date"), _key("mov_date").formats).alias("mov_date"))


def _key(name: str):
    return next(k for k in MOVEMENTS.key if k.name == name)


@query("flag_date")
def flag_date(spark: SparkSession, sf: str) -> DataFrame:
    return demo.normalized(spark, sf).select(*ROW, "dq_date_reformatted")


@query("flag_type")
def flag_type(spark: SparkSession, sf: str) -> DataFrame:
    return demo.normalized(spark, sf).select(*ROW, "dq_type_recoded")


@query("flag_amount")
def flag_amount(spark: SparkSession, sf: str) -> DataFrame:
    return keys.with_hashes(demo.valid(spark, sf), MOVEMENTS).select(
        *ROW, "dq_amount_null", "dq_amount_zero", "dq_amount_negative")


@query("split_valid")
def split_valid(spark: SparkSession, sf: str) -> DataFrame:
    return demo.normalized(spark, sf).select(*ROW, normalize.usable(MOVEMENTS).alias("usable"))


@query("quarantine")
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.quarantine(demo.normalized(spark, sf), MOVEMENTS).drop("_load_ts")


@query("quarantine_stored")
def quarantine_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The published quarantine, after a newest cut that came twice: first with the rows of
    another day, then with its own."""
    store = Store(spark, scratch_path(spark, "store"), MOVEMENTS)
    first, second, third = demo.write_cuts(spark, sf)
    for cut in (first, second, Cut(third.label, first.path, third.cut_date), third):
        pipeline.process_cut(spark, store, cut)
    return store.quarantine().drop("_load_ts", "_source_file")


@query("key_hash")
def key_hash(spark: SparkSession, sf: str) -> DataFrame:
    return demo.valid(spark, sf).select(
        *ROW, hashing.key_hash(MOVEMENTS.key_names).alias("business_key_hash"))


@query("attr_hash")
def attr_hash(spark: SparkSession, sf: str) -> DataFrame:
    return demo.valid(spark, sf).select(
        *ROW, hashing.attribute_hash(MOVEMENTS.attribute_names).alias("attr_hash"))


@query("signed_amount")
def signed_amount(spark: SparkSession, sf: str) -> DataFrame:
    return keys.with_hashes(demo.valid(spark, sf), MOVEMENTS).select(
        *ROW, "type", "amount", "signed_amount")


@query("occurrence_seq")
def occurrence_seq(spark: SparkSession, sf: str) -> DataFrame:
    return demo.staged(spark, sf).select(
        "_cut_label", "business_key_hash", "occurrence_seq", "attr_hash",
        "dq_date_reformatted", "dq_type_recoded")


LINEITEM_KEY = ["l_returnflag", "l_linestatus"]
LINEITEM_ORDER = ["l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate",
                  "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query("occurrence_seq_heavy")
def occurrence_seq_heavy(spark: SparkSession, sf: str) -> DataFrame:
    """Occurrence numbers where a handful of keys hold the whole table."""
    rows = demo.table(spark, sf, "lineitem").select(*LINEITEM_KEY, *LINEITEM_ORDER)
    order = [F.col(c).asc_nulls_last() for c in LINEITEM_ORDER]
    return ranking.number_rows(rows, LINEITEM_KEY, order, "occurrence_seq")


@query("movement_key")
def movement_key(spark: SparkSession, sf: str) -> DataFrame:
    return demo.staged(spark, sf).drop("_load_ts")


@query("stage_key_unique")
def stage_key_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Zero for the movement key; the business key alone repeats."""
    staged = demo.staged(spark, sf)
    return _union([keys.duplicate_keys(staged, k).select(F.lit(k).alias("key"), "*")
                   for k in ("movement_key", "business_key_hash")])


# -- filters ----------------------------------------------------------------------------
@query("cut_slice")
def slice_of_cut(spark: SparkSession, sf: str) -> DataFrame:
    return cut_slice(demo.movements_raw(spark, sf), demo.CUTS[1]).drop("_load_ts")


def _history_columns(h: DataFrame) -> DataFrame:
    """A history without load times, version ids and source files (which differ by run)."""
    return h.select(*[c for c in MOVEMENTS.version_schema.fieldNames()
                      if c not in ("load_ts", "source_file")])


@query("open_versions")
def open_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _history_columns(demo.full_history(spark, sf).filter("is_current"))


@query("live_state")
def live_state(spark: SparkSession, sf: str) -> DataFrame:
    return _history_columns(marts.live_state(demo.full_history(spark, sf)))


@query("tombstones")
def tombstones(spark: SparkSession, sf: str) -> DataFrame:
    return _history_columns(marts.tombstones(demo.full_history(spark, sf)))


# -- change capture: every cut against the state that the one before left ---------------
def _each_cut(spark: SparkSession, sf: str, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return _union([fn(demo.classified(spark, sf, n)).select(F.lit(c.label).alias("cut_label"), "*")
                   for n, c in enumerate(demo.CUTS, start=1)])


def _each_merge(spark: SparkSession, sf: str, condition: str) -> DataFrame:
    return _union([
        _history_columns(merge.versions(demo.classified(spark, sf, n), MOVEMENTS, c)
                         .filter(condition)).select(F.lit(c.label).alias("merged_cut"), "*")
        for n, c in enumerate(demo.CUTS, start=1)])


@query("cdc_full_outer")
def cdc_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    return _each_cut(spark, sf, lambda rows: rows.select(
        "movement_key", F.col("new.attr_hash").isNotNull().alias("has_new"),
        F.col("old.attr_hash").isNotNull().alias("has_old"),
        F.col("old.is_deleted").alias("old_is_deleted"),
        F.col("old.attr_hash").alias("old_attr_hash"),
        F.col("new.attr_hash").alias("new_attr_hash")))


@query("cdc_classify")
def cdc_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _each_cut(spark, sf, lambda rows: rows.select("movement_key", "action", "closes"))


@query("cdc_reappeared")
def cdc_reappeared(spark: SparkSession, sf: str) -> DataFrame:
    return _each_cut(spark, sf, lambda rows: rows.filter(
        F.col("old.is_deleted") & (F.col("action") == INSERT)).select(
        "movement_key", F.col("old.attr_hash").alias("prev_attr_hash"),
        F.col("new.attr_hash").alias("new_attr_hash")))


@query("cdc_new_rows")
def cdc_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _each_cut(spark, sf, lambda rows: rows.filter(
        F.col("action").isin(INSERT, UPDATE)).select(
        "action", *[F.col(f"new.{c}") for c in MOVEMENTS.row_columns]))


@query("cdc_tombstone_rows")
def cdc_tombstone_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _each_cut(spark, sf, lambda rows: rows.filter(F.col("action") == DELETE).select(
        *[F.col(f"old.{c}") for c in MOVEMENTS.row_columns]))


@query("cdc_closed_rows")
def cdc_closed_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _each_cut(spark, sf, lambda rows: rows.filter("closes").select(
        "movement_key", F.col("old.valid_from").alias("valid_from"), "action"))


@query("scd2_closed")
def scd2_closed(spark: SparkSession, sf: str) -> DataFrame:
    return _each_merge(spark, sf, "part = 'closed'")


@query("scd2_new_versions")
def scd2_new_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _each_merge(spark, sf, "opened AND NOT is_deleted")


@query("scd2_tombstones")
def scd2_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    return _each_merge(spark, sf, "opened AND is_deleted")


@query("change_log")
def change_log(spark: SparkSession, sf: str) -> DataFrame:
    return merge.events(demo.full_history(spark, sf))


@query("change_log_stored")
def change_log_stored(spark: SparkSession, sf: str) -> DataFrame:
    return demo.published(spark, sf).change_log().drop("run_id", "ts")


@query("merge_counts")
def merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _union([
        demo.classified(spark, sf, n).agg(*merge.action_counts())
        .select(F.lit(cut.label).alias("cut_label"), "*")
        for n, cut in enumerate(demo.CUTS, start=1)])


@query("merge_idempotent")
def merge_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of merging the last cut again, with itself already published."""
    live = demo.published(spark, sf).open_versions()
    return demo.merged_with(spark, sf, demo.CUTS[-1], live).agg(*merge.action_counts())


@query("version_id")
def version_id(spark: SparkSession, sf: str) -> DataFrame:
    return history.with_version_id(demo.full_history(spark, sf)).select(
        "version_id", "movement_key", "valid_from")


@query("scd2_history")
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return demo.full_history(spark, sf).drop("load_ts")


@query("bulk_from_state")
def bulk_from_state(spark: SparkSession, sf: str) -> DataFrame:
    """The history when the first cut was merged and the others added to its open versions in
    one pass."""
    store = Store(spark, scratch_path(spark, "store"), MOVEMENTS)
    first, *others = demo.write_cuts(spark, sf)
    pipeline.process_cut(spark, store, first)
    pipeline.extend(spark, store, others)
    return _history_columns(store.history())


@query("bootstrap")
def bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every table of a store before the first cut and after the last."""
    empty = Store(spark, scratch_path(spark, "store"), MOVEMENTS).table_sizes()
    full = demo.published(spark, sf).table_sizes()
    return empty.withColumnRenamed("rows", "rows_before").join(
        full.withColumnRenamed("rows", "rows_after"), "table")


@query("history_by_date")
def history_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """The versions that held at some time from the second month to the day before the third
    cut, when the cuts lie months apart; one commit brings the months of all of them."""
    store = Store(spark, scratch_path(spark, "store"), MOVEMENTS)
    cuts = [Cut(c.label, c.path, day)
            for c, day in zip(demo.write_cuts(spark, sf), demo.MONTHS_APART)]
    pipeline.rebuild(spark, store, cuts)
    first, last = demo.MONTHS_APART[1], demo.MONTHS_APART[2] - timedelta(days=1)
    return _history_columns(store.history_between(first, last))


@query("movement_trace")
def movement_trace(spark: SparkSession, sf: str) -> DataFrame:
    return history.trace(demo.full_history(spark, sf)).select(
        "movement_key", "change_type", "is_current", "is_deleted", "valid_from", "valid_to",
        "amount")


# -- marts and reports ------------------------------------------------------------------
def _live(spark: SparkSession, sf: str) -> DataFrame:
    return marts.live_state(demo.full_history(spark, sf))


@query("mart_flow_by_product")
def mart_flow_by_product(spark: SparkSession, sf: str) -> DataFrame:
    return marts.flow_by_product(_live(spark, sf))


@query("mart_flow_by_fund")
def mart_flow_by_fund(spark: SparkSession, sf: str) -> DataFrame:
    return marts.flow_by_fund(_live(spark, sf))


@query("flow_by_type")
def flow_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return marts.flow_by_type(_live(spark, sf))


@query("cdc_summary")
def cdc_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.cdc_summary(merge.events(demo.full_history(spark, sf)))


@query("change_counts")
def change_counts(spark: SparkSession, sf: str) -> DataFrame:
    return marts.change_counts(merge.events(demo.full_history(spark, sf)))


@query("state_summary")
def state_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.state_summary(demo.full_history(spark, sf))


@query("state_summary_incremental")
def state_summary_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The state summary after every cut, kept from the cuts' changes alone."""
    store = demo.checked(spark, sf)
    return _union([store.state_summary(head).select(F.lit(cut.label).alias("cut_label"), "*")
                   for cut, head in demo.heads(store)])


@query("top_clients_incremental")
def top_clients_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The largest clients after every cut, kept from the cuts' changes alone."""
    store = demo.checked(spark, sf)
    return _union([store.top_actors(head=head).select(F.lit(cut.label).alias("cut_label"), "*")
                   for cut, head in demo.heads(store)])


@query("dq_profile")
def dq_profile(spark: SparkSession, sf: str) -> DataFrame:
    return marts.quality_profile(_live(spark, sf))


@query("quarantine_total")
def quarantine_total(spark: SparkSession, sf: str) -> DataFrame:
    return marts.quarantine_total(normalize.quarantine(demo.normalized(spark, sf), MOVEMENTS))


@query("top_clients")
def top_clients(spark: SparkSession, sf: str) -> DataFrame:
    return marts.top_clients(_live(spark, sf))


@query("run_summary")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.run_summary(demo.full_history(spark, sf),
                             normalize.quarantine(demo.normalized(spark, sf), MOVEMENTS))


def _long(name: str, df: DataFrame, item: str | None = None) -> DataFrame:
    """An insight table as (section, item, metric, value) rows."""
    measures = [f.name for f in df.schema if f.name != item
                and f.dataType.simpleString() in ("bigint", "double")]
    label = F.lit("") if item is None else F.col(item)
    return df.select(F.lit(name).alias("section"), label.alias("item"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in measures])))


_ITEM = {"cdc_por_corte": "cut_label", "flujo_por_producto": "product", "por_tipo": "type",
         "top_clientes": "id_cliente"}


@query("insights")
def insights(spark: SparkSession, sf: str) -> DataFrame:
    """The whole bundle, one row per number."""
    results = reports.store_insights(demo.published(spark, sf))
    return _union([_long(n, df, _ITEM.get(n)) for n, df in results.items()])


@query("insights_export")
def insights_export(spark: SparkSession, sf: str) -> DataFrame:
    """The exported JSON of every result, read back."""
    results = reports.store_insights(demo.published(spark, sf))
    paths = reports.export_insights(results, scratch_path(spark, "insights"))
    return _union([_long(n, spark.read.schema(df.schema).json(paths[n]), _ITEM.get(n))
                   for n, df in results.items()])


@query("marts_stored")
def marts_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The marts as a reader finds them after runs of one cut each: the first is summed from
    the live state, each further one from the rows that came and went."""
    store = demo.checked(spark, sf)
    return _union([_long(m.name, store.mart(m.name), m.by) for m in MOVEMENTS.marts])


# -- quality ----------------------------------------------------------------------------
def _copies(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The published history, and a damaged copy in which most assertions find something."""
    clean = demo.published(spark, sf).history()
    return {"clean": clean, "corrupted": corrupted(clean)}


def corrupted(h: DataFrame) -> DataFrame:
    """Blanks out keys, breaks values and dates, and repeats versions."""
    second, change = F.col("occurrence_seq") == 2, F.col("change_type")
    broken = h.select(*[{
        "product": F.when(second, None).otherwise(F.col("product")),
        "type": F.when(F.col("dq_amount_zero"), "OTRO").otherwise(F.col("type")),
        "change_type": F.when(F.col("dq_amount_negative"), "OTHER").otherwise(change),
        "valid_to": F.when(F.col("is_current") & F.col("is_deleted"), F.col("valid_from"))
                     .when(~F.col("is_current") & (change == UPDATE), None)
                     .otherwise(F.col("valid_to")),
    }.get(c, F.col(c)).alias(c) for c in h.columns])
    return broken.unionByName(h.filter(change == UPDATE))


def _per_copy(spark: SparkSession, sf: str, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return _union([fn(h).select(F.lit(n).alias("copy"), "*")
                   for n, h in _copies(spark, sf).items()])


def _suite(*kinds: type) -> tuple:
    return tuple(a for a in quality.MOVEMENTS_SUITE if isinstance(a, kinds))


def _run(h: DataFrame, suite) -> DataFrame:
    tables = reports.checked_tables(h, merge.events(h))
    needed = {a.table for a in suite}
    return quality.run_suite({n: df for n, df in tables.items() if n in needed}, suite)


@query("assert_not_null")
def assert_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return _per_copy(spark, sf, lambda h: _run(h, _suite(quality.NotNull)))


@query("assert_accepted_values")
def assert_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return _per_copy(spark, sf, lambda h: _run(h, _suite(quality.Accepted)))


@query("assert_unique")
def assert_unique(spark: SparkSession, sf: str) -> DataFrame:
    return _per_copy(spark, sf, lambda h: _run(h, _suite(quality.Unique)))


@query("assert_one_open_version")
def assert_one_open_version(spark: SparkSession, sf: str) -> DataFrame:
    return _per_copy(spark, sf, quality.several_open)


@query("assert_one_version_per_cut")
def assert_one_version_per_cut(spark: SparkSession, sf: str) -> DataFrame:
    return _per_copy(spark, sf, quality.several_per_cut)


@query("assert_validity")
def assert_validity(spark: SparkSession, sf: str) -> DataFrame:
    return _per_copy(spark, sf, quality.incoherent_validity)


@query("assert_freshness")
def assert_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """The landed cuts are fresh the day they are due and late two days after."""
    due = demo.CUTS[-1].cut_date
    raw = demo.movements_raw(spark, sf)
    checks = [quality.Fresh("raw", "_cut_date", due + timedelta(days=n), 1) for n in (0, 1, 2)]
    return quality.run_suite({"raw": raw}, checks).groupBy("assertion").agg(
        F.sum("violations").alias("violations"))


@query("quality_gate")
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    """All assertions with their verdict, on the history and on the damaged copy."""
    return _per_copy(spark, sf, lambda h: _run(h, quality.MOVEMENTS_SUITE)).withColumn(
        "passed", F.col("violations") == 0)


# -- growth paths -----------------------------------------------------------------------
AS_OF_DAYS = (date(2024, 10, 31), *(c.cut_date for c in demo.CUTS), date(2024, 12, 31))


@query("as_of_state")
def as_of_state(spark: SparkSession, sf: str) -> DataFrame:
    return history.as_of_many(demo.full_history(spark, sf), AS_OF_DAYS).select(
        "as_of_date", "movement_key", "product", "signed_amount", "cut_label")


@query("as_of_join")
def as_of_join(spark: SparkSession, sf: str) -> DataFrame:
    """What held for every key on each of several days."""
    found = history.as_of_join(demo.probes(spark, sf, AS_OF_DAYS),
                               demo.published(spark, sf).history())
    return found.select("movement_key", "day", *[
        F.col(f"version.{c}").alias(c) for c in ("valid_from", "cut_label", "attr_hash",
                                                 "signed_amount")])


@query("mart_incremental")
def mart_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The product mart kept up to date from each cut's changes alone."""
    state = None
    for n, cut in enumerate(demo.CUTS, start=1):
        merged = merge.versions(demo.classified(spark, sf, n), MOVEMENTS, cut)
        delta = marts.flow_state(marts.merge_delta(merged), FLOW_BY_PRODUCT, F.col("_sign"))
        state = delta if state is None else marts.add_flow(state, delta, FLOW_BY_PRODUCT)
    return marts.finish_flow(state, FLOW_BY_PRODUCT)


@query("natural_key_cdc")
def natural_key_cdc(spark: SparkSession, sf: str) -> DataFrame:
    return demo.orders_history(spark, sf).drop("load_ts")
