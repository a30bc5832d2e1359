"""One query per operator: ``name -> function(spark, sf_dir)``."""

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnlake.functions import (
    decimal_comma,
    first_chars,
    json_text,
    parse_record,
    parse_timestamp,
    trailing_number,
)
from tarnlake.operators import (
    annual_metrics,
    between,
    check_not_empty,
    count_rows,
    date_range,
    distinct_ids,
    enrich,
    enrich_sql,
    heavy_keys,
    except_all,
    latest_batch,
    latest_per_key,
    latest_slice,
    null_profile,
    preview,
    reconcile_ids,
    row_number_desc,
)
from tarnlake.plans import build_report, clean_file, load_dimension, save_report
from tarnlake.session import work_folder
from tarnlake.sources import (
    append_table,
    create_schema_if_absent,
    create_table_if_absent,
    overwrite_table,
    read_delimited,
    read_snapshot,
    read_table,
    redelimit,
    write_batches,
    write_delimited,
)
from tarnlake.streaming import (
    BatchStore,
    NewestRows,
    ProgressLog,
    YearlyMetrics,
    cut_for_replay,
    drain,
    finish,
    ingest,
    parse_messages,
    replay,
    store_batch,
    store_batches,
)
from workloads.fixture import (
    event_file_stream,
    event_messages,
    ledger,
    methods,
    numbered_orders,
    samples,
    sites,
    stored_ledger,
    stored_snapshots,
    table,
    short_batches,
    short_batch_store,
)

MEANS = ("AVG_PH", "AVG_SO4", "AVG_NO3")
METRIC_NAMES = {"site": "SITE_ID", "program": "PROGRAM_ID"}


def rounded(metrics):
    """Engines add doubles in different orders; compare means to six decimals."""
    return metrics.withColumns({m: F.round(m, 6) for m in MEANS})


# Sources and sinks


def other_layout(rows):
    """The rows with their columns in another order, and one that nobody declares."""
    return rows.select(F.lit("more").alias("MORE"), *reversed(rows.columns))


def scan_table(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")


def scan_delimited_csv(spark, d):
    part, folder = table(spark, d, "part"), work_folder(spark, "csv")
    write_delimited(other_layout(part), folder, ";")
    return read_delimited(spark, folder, part.schema, ";")


def csv_redelimit(spark, d):
    # Quotes, both delimiters and blanks at the edges are part of the value.
    quoted = F.format_string(' "%s"; , ', "c_name")
    customer = table(spark, d, "customer").withColumn("c_name", quoted)
    source, target = work_folder(spark, "csv"), work_folder(spark, "csv")
    write_delimited(customer, source, ";")
    redelimit(spark, source, target)
    return read_delimited(spark, target, customer.schema, ",")


def csv_clean_profile(spark, d):
    customer = table(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "NA").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    source, target = work_folder(spark, "csv"), work_folder(spark, "csv")
    write_delimited(customer, source, ";")
    return clean_file(spark, source, target)


def load_dimension_query(spark, d):
    rows = methods(spark, d)
    source, target = work_folder(spark, "csv"), work_folder(spark, "dimension")
    write_delimited(other_layout(rows), source, ";")
    return load_dimension(spark, source, rows.schema, target, end_year_column="END_YEAR")


def ddl_create_if_absent(spark, d):
    customer = table(spark, d, "customer")
    folder, location = work_folder(spark, "schema"), work_folder(spark, "external")
    schema = "tarnlake_" + folder.rsplit("-", 1)[1]
    for create in (1, 2):
        create_schema_if_absent(spark, schema, folder)
        create_table_if_absent(spark, f"{schema}.customer", customer.schema, location)
        if create == 1:
            append_table(customer, f"{schema}.customer")
    # The table is external: its rows stay when the catalog entries go.
    spark.sql(f"DROP TABLE {schema}.customer")
    spark.sql(f"DROP SCHEMA {schema}")
    return read_table(spark, location)


def sink_append(spark, d):
    orders, target = table(spark, d, "orders"), work_folder(spark, "append")
    newer = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    append_table(orders.filter(~newer), target)
    append_table(orders.filter(newer), target)
    return read_table(spark, target)


def sink_append_idempotent(spark, d):
    orders, target = numbered_orders(spark, d), work_folder(spark, "batches")
    write_batches(orders, target, "batch_id", rebalance=True)
    write_batches(orders.filter("batch_id = 2"), target, "batch_id", rebalance=True)
    return read_table(spark, target)


def sink_overwrite(spark, d):
    customer, target = table(spark, d, "customer"), work_folder(spark, "overwrite")
    overwrite_table(customer.withColumn("c_name", F.lit("replaced later")), target)
    overwrite_table(customer, target)
    return read_table(spark, target)


def sink_overwrite_self(spark, d):
    """A table made from itself, after a replacement that fails half-way."""
    customer, target = table(spark, d, "customer"), work_folder(spark, "overwrite")
    overwrite_table(customer, target)
    half = F.when(F.col("c_custkey") % 2 == 0, F.raise_error(F.lit("planned"))).otherwise(F.col("c_custkey"))
    try:
        overwrite_table(read_table(spark, target).withColumn("c_custkey", half.cast("long")), target)
    except PySparkException:
        pass
    overwrite_table(read_table(spark, target).withColumn("c_acctbal", -F.col("c_acctbal")), target)
    return read_table(spark, target)


def snapshot_by_year(spark, d):
    _, root = stored_snapshots(spark, d)
    return read_table(spark, root).groupBy("year", "batch_id").agg(F.count(F.lit(1)).alias("row_count"))


def snapshot_restore(spark, d):
    kept, _ = stored_snapshots(spark, d)
    return read_snapshot(spark, kept)


def rows_to_json(spark, d):
    return table(spark, d, "events").select("event_id", json_text("event_id", "event_type", "value").alias("value"))


# Scalar expressions


def json_parse_expand(spark, d):
    props = parse_record("props", StructType.fromDDL("k int")).alias("props")
    return table(spark, d, "events").select("event_id", props).select("event_id", "props.*")


def parse_timestamp_query(spark, d):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return table(spark, d, "orders").select(
        "o_orderkey",
        parse_timestamp(text).cast("timestamp_ntz").alias("parsed"),
        parse_timestamp(F.date_format("o_orderdate", "dd/MM/yyyy")).cast("timestamp_ntz").alias("unfit"),
    )


def extract_batch_number(spark, d):
    return table(spark, d, "customer").select("c_custkey", trailing_number("c_name", "Customer#").alias("number"))


def decimal_comma_query(spark, d):
    return samples(spark, d).select(
        "SAMPLE_NO", *[decimal_comma(c).alias(c) for c in ("PH_LAB", "SO4_UEQ_L", "NO3_UEQ_L")]
    )


def substr_year(spark, d):
    return table(spark, d, "orders").select("o_orderkey", first_chars("o_orderdate").alias("end_date"))


# Projections and filters


def project_alias(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("SAMPLE_NO"), F.col("o_custkey").alias("SITE_ID"))
    customer = table(spark, d, "customer").select(
        F.col("c_custkey").alias("SITE_ID"), F.col("c_nationkey").alias("PROGRAM_ID")
    )
    joined = enrich(orders.withColumn("PROGRAM_ID", F.lit(0)), customer, newest_methods(spark, d), site_keys=("SITE_ID",))
    found = joined.where("SITE_ID_SITE IS NOT NULL")
    return found.select("SAMPLE_NO", "SITE_ID_LTM", "SITE_ID_SITE", "PROGRAM_ID_SITE")


def batch_slice_range(spark, d):
    low, high = (F.lit(t).cast("timestamp_ntz") for t in ("1997-01-15", "1997-03-15"))
    return between(table(spark, d, "orders"), "o_orderdate", low, high)


# Histories


def row_number_desc_query(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return row_number_desc(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


def hot_parts(spark, d):
    """Line items with a third of all rows on one part."""
    part = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_partkey")).alias("part")
    return table(spark, d, "lineitem").select(part, "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")


def heavy_keys_query(spark, d):
    return heavy_keys(hot_parts(spark, d), ["part"], share=0.01)


def row_number_hot_key(spark, d):
    """The hot part's rows are numbered slice by slice, with nothing said about it."""
    lines = hot_parts(spark, d).drop("l_quantity")
    return row_number_desc(lines, ["part"], "l_shipdate", ["l_orderkey", "l_linenumber"])


def scd1_latest(spark, d):
    return latest_per_key(samples(spark, d), ["SITE_ID"], "DATE_SMP", ["SAMPLE_NO"])


def scd1_latest_composite(spark, d):
    return latest_per_key(table(spark, d, "events"), ["user_id", "event_type"], "ts", ["event_id"])


def scd1_latest_year_text(spark, d):
    return latest_per_key(methods(spark, d), ["PROGRAM_ID"], "END_YEAR", ["METHOD_NO"])


# Joins


def newest_methods(spark, d):
    return scd1_latest_year_text(spark, d)


def left_join_composite(spark, d):
    joined = enrich(samples(spark, d), sites(spark, d), newest_methods(spark, d))
    return joined.withColumnsRenamed({"SITE_ID_LTM": "SITE_ID", "PROGRAM_ID_LTM": "PROGRAM_ID"}).select(
        "SITE_ID", "PROGRAM_ID", "SAMPLE_NO", "SITE_NAME", "STATE"
    )


def left_join_chained(spark, d):
    joined = enrich(samples(spark, d), sites(spark, d), newest_methods(spark, d))
    return joined.select("SAMPLE_NO", "SITE_ID_LTM", "PROGRAM_ID_LTM", "PROGRAM_ID_SITE", "PROGRAM_ID_METHODE", "METHOD")


def enrich_left_join(spark, d):
    return enrich(samples(spark, d), sites(spark, d), newest_methods(spark, d))


def enrich_left_join_sql(spark, d):
    return enrich_sql(samples(spark, d), sites(spark, d), newest_methods(spark, d))


def enrich_hot_site(spark, d):
    """A third of the samples belong to one site, which is found where sites are not broadcast."""
    samples = hot_parts(spark, d).withColumnsRenamed({"part": "SITE_ID", "l_quantity": "VALUE"})
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("SITE_ID"), F.col("o_totalprice").alias("SIZE"))
    described = orders.withColumn("PROGRAM_ID", F.col("SITE_ID") % 5)
    joined = enrich(
        samples.withColumn("PROGRAM_ID", F.col("SITE_ID") % 5), described, newest_methods(spark, d)
    )
    return joined.select("l_orderkey", "l_linenumber", "VALUE", "SITE_ID_LTM", "SITE_ID_SITE", "SIZE", "METHOD")


def enrich_shared_names(spark, d, form=enrich):
    """All three tables have a column STATE; samples of a site go to eight tasks."""
    measured = samples(spark, d).withColumn("STATE", F.col("SO4_UEQ_L"))
    described = newest_methods(spark, d).withColumn("STATE", F.col("METHOD"))
    joined = form(measured, sites(spark, d), described, spread=8)
    return joined.select("SAMPLE_NO", "STATE", "STATE_METHODE", "STATE_SITE")


def enrich_shared_names_sql(spark, d):
    return enrich_shared_names(spark, d, enrich_sql)


# Aggregates, checks and sets


def count_rows_query(spark, d):
    return count_rows(table(spark, d, "events"))


def batch_min_max(spark, d):
    return date_range(table(spark, d, "events"), "ts")


def distinct_ids_query(spark, d):
    return distinct_ids(table(spark, d, "events"), "user_id")


def annual_metrics_query(spark, d):
    return rounded(annual_metrics(samples(spark, d), **METRIC_NAMES))


def null_profile_query(spark, d):
    lines = table(spark, d, "lineitem")
    gaps = {c: F.nullif(F.col(c), F.lit(v)) for c, v in (("l_discount", 0.0), ("l_tax", 0.0), ("l_returnflag", "N"))}
    return null_profile(lines.withColumns(gaps))


def preview_limit(spark, d):
    return preview(table(spark, d, "orders"), ["o_orderkey"])


def except_all_query(spark, d):
    orders, events = table(spark, d, "orders"), table(spark, d, "events")
    return except_all(orders.select("o_custkey"), events.select("user_id"))


def reconcile_ids_query(spark, d):
    return reconcile_ids(
        sites(spark, d), table(spark, d, "events"), "SITE_ID", "user_id", left_name="sites", right_name="events"
    )


# Batches


def batch_ledger(spark, d):
    return ledger(spark, d)


def latest_batch_query(spark, d):
    return latest_batch(stored_ledger(spark, d)).select("batch_number", "min_datestamp", "max_datestamp")


def latest_batch_slice(spark, d):
    return latest_slice(table(spark, d, "orders"), "o_orderdate", stored_ledger(spark, d))


# Reports


def report(spark, d, kept=None):
    return build_report(
        samples(spark, d),
        sites(spark, d),
        methods(spark, d),
        kept,
        sample_tie_break=("SAMPLE_NO",),
        method_tie_break=("METHOD_NO",),
        ties_are_unique=True,
    )


def latest_batch_metrics(spark, d):
    return rounded(report(spark, d, stored_ledger(spark, d)).metrics)


def latest_batch_reconciliation(spark, d):
    return report(spark, d, stored_ledger(spark, d)).reconciliation


def latest_sample_metrics(spark, d):
    return rounded(report(spark, d).metrics)


def report_saved(spark, d):
    joined, target = work_folder(spark, "joined"), work_folder(spark, "metrics")
    result = report(spark, d, stored_ledger(spark, d))
    for _ in range(2):
        metrics = save_report(result, joined, target, "batch_13")
    return rounded(metrics)


def report_reconciliation_saved(spark, d):
    joined, target, missing = (work_folder(spark, n) for n in ("joined", "metrics", "missing"))
    result = report(spark, d, stored_ledger(spark, d))
    for _ in range(2):
        save_report(result, joined, target, "batch_13", missing)
    return read_table(spark, missing).drop("version_id")


def check_not_empty_query(spark, d):
    return check_not_empty(report(spark, d, stored_ledger(spark, d)).metrics, "metrics")


# Streams


def stream_json_ingest(spark, d):
    schema = table(spark, d, "events").schema
    target, checkpoint = work_folder(spark, "stream"), work_folder(spark, "progress")
    query = (
        parse_messages(event_messages(spark, d), schema)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    drain(query)
    return read_table(spark, target, schema)


def _ingested(spark, d, on_batch=store_batch, restarts=0):
    """Store all events; a stream that ends with an error is started again."""
    schema = table(spark, d, "events").schema
    messages, checkpoint = event_messages(spark, d), work_folder(spark, "progress")
    store = BatchStore(work_folder(spark, "store"))
    for left in range(restarts, -1, -1):
        try:
            query = drain(ingest(messages, schema, store, checkpoint, date_column="ts", on_batch=on_batch))
            return query, store, schema
        except StreamingQueryException:
            if not left:
                raise


def stream_foreach_batch(spark, d):
    _, store, schema = _ingested(spark, d)
    return store.table(spark, schema).drop("batch_id")


def stream_restart(spark, d):
    failed = []

    def fail_once(batch, batch_id, store, date_column):
        store_batch(batch, batch_id, store, date_column)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("planned failure after the batch was written")

    _, store, schema = _ingested(spark, d, fail_once, restarts=1)
    return store.table(spark, schema).drop("batch_id")


def stream_batch_ledger(spark, d):
    _, store, schema = _ingested(spark, d)
    kept = store.ledger(spark, schema["ts"].dataType)
    return kept.agg(
        F.min("min_datestamp").alias("min_datestamp"),
        F.max("max_datestamp").alias("max_datestamp"),
        F.sum("row_count").cast("long").alias("row_count"),
        F.sum("corrupt_count").cast("long").alias("corrupt_count"),
    )


def stream_paced_replay(spark, d):
    schema = table(spark, d, "events").schema
    target, checkpoint = work_folder(spark, "replayed"), work_folder(spark, "progress")
    drain(replay(event_file_stream(spark, d), target, checkpoint))
    return parse_messages(spark.read.text(target), schema)


def _replayed(spark, d, pace):
    """What a replay of the events sent, and its log of micro-batches."""
    target, log = work_folder(spark, "replayed"), ProgressLog(spark, work_folder(spark, "pace"))
    spark.streams.addListener(log)
    try:
        sent = finish(replay(cut_for_replay(table(spark, d, "events"), pace), target, work_folder(spark, "progress"), "0 seconds"))
    finally:
        log.close()
    return target, log.rows().where((F.col("query_id") == sent.id) & (F.col("row_count") > 0))


def stream_replay_pace(spark, d):
    """All events sent, so many rows at a time; batches above that are counted."""
    pace = 5000
    _, log = _replayed(spark, d, pace)
    return log.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("rows_sent"),
        F.count_if(F.col("row_count") > pace).alias("batches_above_pace"),
    )


def stream_replay_batches(spark, d):
    """The rows of every micro-batch of a replay, in order: all have 5000 but the last."""
    _, log = _replayed(spark, d, 5000)
    number = F.row_number().over(Window.orderBy("batch_id")).cast("long") - 1
    return log.select(number.alias("batch_number"), "row_count")


def stream_compacted_ledger(spark, d):
    _, store, schema = _ingested(spark, d)
    for _ in range(2):
        store.compact_ledger(spark, schema["ts"].dataType)
    return store.table(spark, schema).drop("batch_id")


# Stored batches


def store_latest_slice(spark, d):
    """The last batch's range, cut out of the few folders whose dates meet it."""
    store, schema = short_batch_store(spark, d)
    return store.latest_slice(spark, schema, "o_orderdate").drop("batch_id")


def store_compacted(spark, d):
    """All batches after folding, a batch stored anew, folding again and clearing up."""
    store, schema = short_batch_store(spark, d)
    kind = schema["o_orderdate"].dataType
    store.compact(spark, schema, kind)
    store_batches(short_batches(spark, d).where("batch_id = 7"), "batch_id", store, "o_orderdate")
    store.compact(spark, schema, kind)
    store.compact_ledger(spark, kind)
    store.vacuum(spark, 0)
    return store.table(spark, schema)


def store_as_of(spark, d):
    """The table as it was after its batches up to 100, read after a fold and a batch stored anew."""
    store, schema = short_batch_store(spark, d, F.col("batch_id") <= 100, F.col("batch_id") > 100)
    store.compact(spark, schema, schema["o_orderdate"].dataType)
    store_batches(short_batches(spark, d).where("batch_id = 150"), "batch_id", store, "o_orderdate")
    return store.table(spark, schema, as_of="batch_100")


def store_rollback(spark, d):
    """Back to the batches up to 100, and then on with batch 150."""
    store, schema = short_batch_store(spark, d, F.col("batch_id") <= 100, F.col("batch_id") > 100)
    store.rollback(spark, "batch_100", schema["o_orderdate"].dataType)
    store_batches(short_batches(spark, d).where("batch_id = 150"), "batch_id", store, "o_orderdate")
    return store.table(spark, schema)


def store_published(spark, d):
    """The catalog's table of the batches, after a retry and a fold, one year of it."""
    store, schema = short_batch_store(spark, d)
    kind, name = schema["o_orderdate"].dataType, "published_" + store.root.rsplit("-", 1)[1]
    store.publish(spark, name, schema, kind)
    store_batches(short_batches(spark, d).where("batch_id = 7"), "batch_id", store, "o_orderdate")
    store.publish(spark, name, schema, kind)
    store.compact(spark, schema, kind)
    store.publish(spark, name, schema, kind)
    return spark.table(name).where("year IN ('1995', '1996')").select(*schema.fieldNames(), "year")


def state_newest_rows(spark, d):
    """The newest order of each customer, taken in half-year by half-year: late ones first, some twice."""
    orders = numbered_orders(spark, d)
    state = NewestRows(work_folder(spark, "newest"), ("o_custkey",), "o_orderdate", ("o_orderkey",), buckets=8)
    for number in (5, -6, 11, 0, 5, 3):
        few = (F.col("batch_id") % 3 == number % 3) if number < 0 else (F.col("batch_id") == number)
        state.merge(orders.where(few).drop("batch_id"), number)
    state.merge(orders.drop("batch_id"), 100)
    return state.table(spark, orders.drop("batch_id").schema)


def state_yearly_metrics(spark, d):
    """Yearly means from the parts of four batches: one is stored twice, one is withdrawn."""
    rows = samples(spark, d).withColumn("n", F.col("SAMPLE_NO") % 4)
    state = YearlyMetrics(work_folder(spark, "metric-parts"))
    state.put(rows.where("n = 2").withColumn("PH_LAB", F.lit("1,0")), 2)
    for number in (0, 1, 2, 3):
        state.put(rows.where(F.col("n") == number), number)
    state.withdraw(spark, 1)
    return rounded(state.metrics(spark))


def stream_progress(spark, d):
    log = ProgressLog(spark, work_folder(spark, "log"))
    spark.streams.addListener(log)
    try:
        query, _, _ = _ingested(spark, d)
    finally:
        log.close()
    return log.rows().where(F.col("query_id") == query.id).agg(
        F.sum("row_count").cast("long").alias("rows_seen"),
        F.count_if(F.col("seconds") <= 0).alias("untimed_batches"),
    )


QUERIES = {
    "scan_table": scan_table,
    "scan_delimited_csv": scan_delimited_csv,
    "csv_redelimit": csv_redelimit,
    "csv_clean_profile": csv_clean_profile,
    "load_dimension": load_dimension_query,
    "ddl_create_if_absent": ddl_create_if_absent,
    "sink_append": sink_append,
    "sink_append_idempotent": sink_append_idempotent,
    "sink_overwrite": sink_overwrite,
    "sink_overwrite_self": sink_overwrite_self,
    "snapshot_by_year": snapshot_by_year,
    "snapshot_restore": snapshot_restore,
    "rows_to_json": rows_to_json,
    "json_parse_expand": json_parse_expand,
    "parse_timestamp": parse_timestamp_query,
    "extract_batch_number": extract_batch_number,
    "decimal_comma": decimal_comma_query,
    "substr_year": substr_year,
    "project_alias": project_alias,
    "batch_slice_range": batch_slice_range,
    "row_number_desc": row_number_desc_query,
    "row_number_hot_key": row_number_hot_key,
    "heavy_keys": heavy_keys_query,
    "scd1_latest": scd1_latest,
    "scd1_latest_composite": scd1_latest_composite,
    "scd1_latest_year_text": scd1_latest_year_text,
    "left_join_composite": left_join_composite,
    "left_join_chained": left_join_chained,
    "enrich_left_join": enrich_left_join,
    "enrich_left_join_sql": enrich_left_join_sql,
    "enrich_hot_site": enrich_hot_site,
    "enrich_shared_names": enrich_shared_names,
    "enrich_shared_names_sql": enrich_shared_names_sql,
    "count_rows": count_rows_query,
    "batch_min_max": batch_min_max,
    "distinct_ids": distinct_ids_query,
    "annual_metrics": annual_metrics_query,
    "null_profile": null_profile_query,
    "preview_limit": preview_limit,
    "except_all": except_all_query,
    "reconcile_ids": reconcile_ids_query,
    "batch_ledger": batch_ledger,
    "latest_batch": latest_batch_query,
    "latest_batch_slice": latest_batch_slice,
    "latest_batch_metrics": latest_batch_metrics,
    "latest_batch_reconciliation": latest_batch_reconciliation,
    "latest_sample_metrics": latest_sample_metrics,
    "report_saved": report_saved,
    "report_reconciliation_saved": report_reconciliation_saved,
    "check_not_empty": check_not_empty_query,
    "stream_json_ingest": stream_json_ingest,
    "stream_foreach_batch": stream_foreach_batch,
    "stream_restart": stream_restart,
    "stream_batch_ledger": stream_batch_ledger,
    "stream_paced_replay": stream_paced_replay,
    "stream_replay_pace": stream_replay_pace,
    "stream_replay_batches": stream_replay_batches,
    "stream_compacted_ledger": stream_compacted_ledger,
    "stream_progress": stream_progress,
    "store_latest_slice": store_latest_slice,
    "store_compacted": store_compacted,
    "store_as_of": store_as_of,
    "store_rollback": store_rollback,
    "store_published": store_published,
    "state_newest_rows": state_newest_rows,
    "state_yearly_metrics": state_yearly_metrics,
}
