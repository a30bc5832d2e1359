"""For each query the SQL that a DuckDB run over the same tables must agree with."""


def _samples() -> str:
    return """
    samples AS (
      SELECT o_custkey AS SITE_ID, c_nationkey AS PROGRAM_ID, o_orderdate AS DATE_SMP,
             replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS PH_LAB,
             CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS VARCHAR) || ',5'
                                WHEN 'P' THEN 'NaN' ELSE '<0,5' END AS SO4_UEQ_L,
             replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS NO3_UEQ_L,
             o_orderkey AS SAMPLE_NO
      FROM orders JOIN customer ON o_custkey = c_custkey
    )"""


def _sites() -> str:
    return """
    sites AS (
      SELECT c_custkey AS SITE_ID, c_nationkey AS PROGRAM_ID, c_name AS SITE_NAME,
             c_mktsegment AS STATE, CAST(2000 + c_custkey % 20 AS INTEGER) AS UPDATE_DATE
      FROM customer WHERE c_acctbal >= 0
    )"""


def _methods() -> str:
    return """
    all_methods AS (
      SELECT s_nationkey AS PROGRAM_ID, CAST(1990 + s_suppkey % 30 AS VARCHAR) AS END_YEAR,
             s_name AS METHOD, s_suppkey AS METHOD_NO
      FROM supplier
    ),
    methods AS (
      SELECT * FROM all_methods
      QUALIFY row_number() OVER (PARTITION BY PROGRAM_ID
        ORDER BY make_date(CAST(END_YEAR AS BIGINT), 1, 1) DESC NULLS LAST, METHOD_NO DESC) = 1
    )"""


def _number(column: str) -> str:
    return f"nullif(TRY_CAST(regexp_replace({column}, ',', '.', 'g') AS DOUBLE), CAST('NaN' AS DOUBLE))"


def _newest(source: str) -> str:
    return f"""
      SELECT * FROM {source}
      QUALIFY row_number() OVER (PARTITION BY SITE_ID
        ORDER BY CAST(DATE_SMP AS DATE) DESC NULLS LAST, SAMPLE_NO DESC) = 1"""


def _metrics(source: str) -> str:
    return f"""
      SELECT SITE_ID, PROGRAM_ID, CAST(year(DATE_SMP) AS INTEGER) AS YEAR,
             round(avg({_number("PH_LAB")}), 6) AS AVG_PH,
             round(avg({_number("SO4_UEQ_L")}), 6) AS AVG_SO4,
             round(avg({_number("NO3_UEQ_L")}), 6) AS AVG_NO3,
             count(*) AS TOTAL_SAMPLES
      FROM {source} GROUP BY 1, 2, 3"""


def _ledger() -> str:
    return """
    ledger AS (
      SELECT CAST((year(o_orderdate) - 1995) * 2 + CASE WHEN month(o_orderdate) > 6 THEN 1 ELSE 0 END AS INTEGER) AS batch,
             min(o_orderdate) AS min_datestamp, max(o_orderdate) AS max_datestamp, count(*) AS row_count
      FROM orders GROUP BY 1
    ),
    last_batch AS (SELECT * FROM ledger ORDER BY batch DESC LIMIT 1)"""


def _last_slice() -> str:
    return """
    sliced AS (
      SELECT s.* FROM samples s, last_batch b
      WHERE s.DATE_SMP >= b.min_datestamp AND s.DATE_SMP <= b.max_datestamp
    )"""


def _joined(columns: str, source: str = "samples") -> str:
    return f"""
      SELECT {columns}
      FROM {source} AS s
      LEFT JOIN sites AS t ON s.SITE_ID = t.SITE_ID AND s.PROGRAM_ID = t.PROGRAM_ID
      LEFT JOIN methods AS m ON t.PROGRAM_ID = m.PROGRAM_ID"""


_JOINED_COLUMNS = """
    s.SITE_ID AS SITE_ID_LTM, s.PROGRAM_ID AS PROGRAM_ID_LTM, s.DATE_SMP, s.PH_LAB, s.SO4_UEQ_L,
    s.NO3_UEQ_L, s.SAMPLE_NO, m.PROGRAM_ID AS PROGRAM_ID_METHODE, m.END_YEAR, m.METHOD, m.METHOD_NO,
    t.SITE_ID AS SITE_ID_SITE, t.PROGRAM_ID AS PROGRAM_ID_SITE, t.SITE_NAME, t.STATE, t.UPDATE_DATE"""

_ALL_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

_FULL_JOIN = f"WITH {_samples()}, {_sites()}, {_methods()} {_joined(_JOINED_COLUMNS)}"

_SHARED_NAMES = f"""
    WITH {_samples()}, {_sites()}, {_methods()}
    {_joined("s.SAMPLE_NO, s.SO4_UEQ_L AS STATE, m.METHOD AS STATE_METHODE, t.STATE AS STATE_SITE")}"""

_HOT_PARTS = """
    hot_parts AS (
      SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS part,
             l_shipdate, l_orderkey, l_linenumber, l_quantity
      FROM lineitem
    )"""

_JOINED_METRIC_COLUMNS = "s.SITE_ID, s.PROGRAM_ID, s.DATE_SMP, s.PH_LAB, s.SO4_UEQ_L, s.NO3_UEQ_L"

_LATEST_METRICS = f"""
    WITH {_samples()}, {_sites()}, {_methods()}, {_ledger()}, {_last_slice()},
    newest AS ({_newest("sliced")}),
    joined AS ({_joined(_JOINED_METRIC_COLUMNS, "newest")})
    {_metrics("joined")}"""

RECONCILIATION = f"""
    WITH {_samples()}, {_sites()}, {_ledger()}, {_last_slice()}
    SELECT 'sites' AS missing_in, SITE_ID FROM (SELECT SITE_ID FROM sliced EXCEPT SELECT SITE_ID FROM sites)
    UNION ALL
    SELECT 'samples', SITE_ID FROM (SELECT SITE_ID FROM sites EXCEPT SELECT SITE_ID FROM sliced)"""

_STRETCH = "CAST(floor(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 12) AS INTEGER)"

ORACLES = {
    "scan_table": "SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem",
    "scan_delimited_csv": "SELECT * FROM part",
    "csv_redelimit": """SELECT * REPLACE (' "' || c_name || '"; , ' AS c_name) FROM customer""",
    "csv_clean_profile": """
        SELECT 0 AS position, 'c_custkey' AS column_name,
               CASE WHEN max(c_custkey) <= 2147483647 THEN 'int' ELSE 'bigint' END AS data_type,
               count(*) FILTER (c_custkey IS NULL) AS null_count FROM customer
        UNION ALL SELECT 1, 'c_acctbal', 'double', count(*) FILTER (c_acctbal < 0) FROM customer
        UNION ALL SELECT 2, 'c_mktsegment', 'string', count(*) FILTER (c_mktsegment = 'MACHINERY') FROM customer""",
    "load_dimension": f"WITH {_methods()} SELECT *, substr(END_YEAR, 1, 4) AS end_date FROM all_methods",
    "ddl_create_if_absent": "SELECT * FROM customer",
    "sink_append": "SELECT * FROM orders",
    "sink_append_idempotent": """
        SELECT *, CAST((year(o_orderdate) - 1995) * 2 + CASE WHEN month(o_orderdate) > 6 THEN 1 ELSE 0 END AS INTEGER) AS batch_id
        FROM orders""",
    "sink_overwrite": "SELECT * FROM customer",
    "sink_overwrite_self": "SELECT * REPLACE (-c_acctbal AS c_acctbal) FROM customer",
    "store_latest_slice": f"""
        WITH last_batch AS (
          SELECT {_STRETCH} AS batch, min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 1
        )
        SELECT orders.* FROM orders, last_batch WHERE o_orderdate >= low AND o_orderdate <= high""",
    "store_compacted": f"SELECT *, {_STRETCH} AS batch_id FROM orders",
    "store_as_of": f"SELECT *, {_STRETCH} AS batch_id FROM orders WHERE {_STRETCH} <= 100",
    "store_rollback": f"SELECT *, {_STRETCH} AS batch_id FROM orders WHERE {_STRETCH} <= 100 OR {_STRETCH} = 150",
    "store_published": f"""
        WITH first_dates AS (SELECT {_STRETCH} AS batch, min(o_orderdate) AS low FROM orders GROUP BY 1)
        SELECT orders.*, CAST(year(low) AS VARCHAR) AS year FROM orders JOIN first_dates ON batch = {_STRETCH} WHERE year(low) IN (1995, 1996)""",
    "snapshot_by_year": f"""
        WITH {_ledger()}
        SELECT CAST(year(min_datestamp) AS INTEGER) AS year, batch AS batch_id, row_count FROM ledger""",
    "snapshot_restore": f"""
        WITH {_ledger()}
        SELECT orders.* FROM orders, last_batch
        WHERE o_orderdate >= min_datestamp AND o_orderdate <= max_datestamp""",
    "rows_to_json": """
        SELECT event_id,
               CAST(to_json({'event_id': event_id, 'event_type': event_type, 'value': value}) AS VARCHAR) AS value
        FROM events""",
    "json_parse_expand": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "parse_timestamp": """
        SELECT o_orderkey,
               try_strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed,
               try_strptime(strftime(o_orderdate, '%d/%m/%Y'), '%Y-%m-%d %H:%M:%S') AS unfit
        FROM orders""",
    "extract_batch_number": r"""
        SELECT c_custkey, TRY_CAST(regexp_extract(c_name, 'Customer#(\d+)', 1) AS INTEGER) AS number FROM customer""",
    "decimal_comma": f"""
        WITH {_samples()}
        SELECT SAMPLE_NO, {_number("PH_LAB")} AS PH_LAB, {_number("SO4_UEQ_L")} AS SO4_UEQ_L,
               {_number("NO3_UEQ_L")} AS NO3_UEQ_L
        FROM samples""",
    "substr_year": "SELECT o_orderkey, substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS end_date FROM orders",
    "project_alias": """
        SELECT o_orderkey AS SAMPLE_NO, o_custkey AS SITE_ID_LTM, c_custkey AS SITE_ID_SITE,
               c_nationkey AS PROGRAM_ID_SITE
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "batch_slice_range": """
        SELECT * FROM orders
        WHERE o_orderdate >= TIMESTAMP '1997-01-15' AND o_orderdate <= TIMESTAMP '1997-03-15'""",
    "row_number_desc": """
        SELECT o_custkey, o_orderdate, o_orderkey,
               CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS BIGINT) AS row_num
        FROM orders""",
    "row_number_hot_key": f"""
        WITH {_HOT_PARTS}
        SELECT part, l_shipdate, l_orderkey, l_linenumber,
               CAST(row_number() OVER (PARTITION BY part ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS BIGINT) AS row_num
        FROM hot_parts""",
    "heavy_keys": f"""
        WITH {_HOT_PARTS}
        SELECT part, count(*) AS n_rows FROM hot_parts GROUP BY part
        HAVING count(*) >= 10000 AND count(*) > 0.01 * (SELECT count(*) FROM hot_parts)""",
    "scd1_latest": f"WITH {_samples()} {_newest('samples')}",
    "scd1_latest_composite": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type
          ORDER BY CAST(ts AS DATE) DESC NULLS LAST, event_id DESC) = 1""",
    "scd1_latest_year_text": f"WITH {_methods()} SELECT * FROM methods",
    "left_join_composite": f"""
        WITH {_samples()}, {_sites()}
        SELECT s.SITE_ID, s.PROGRAM_ID, s.SAMPLE_NO, t.SITE_NAME, t.STATE
        FROM samples AS s LEFT JOIN sites AS t ON s.SITE_ID = t.SITE_ID AND s.PROGRAM_ID = t.PROGRAM_ID""",
    "left_join_chained": f"""
        WITH {_samples()}, {_sites()}, {_methods()}
        {_joined('''s.SAMPLE_NO, s.SITE_ID AS SITE_ID_LTM, s.PROGRAM_ID AS PROGRAM_ID_LTM,
            t.PROGRAM_ID AS PROGRAM_ID_SITE, m.PROGRAM_ID AS PROGRAM_ID_METHODE, m.METHOD''')}""",
    "enrich_left_join": _FULL_JOIN,
    "enrich_left_join_sql": _FULL_JOIN,
    "enrich_hot_site": f"""
        WITH {_HOT_PARTS}, {_methods()}
        SELECT l_orderkey, l_linenumber, l_quantity AS VALUE, part AS SITE_ID_LTM, o_orderkey AS SITE_ID_SITE,
               o_totalprice AS SIZE, m.METHOD
        FROM hot_parts LEFT JOIN orders ON part = o_orderkey
        LEFT JOIN methods AS m ON o_orderkey % 5 = m.PROGRAM_ID""",
    "enrich_shared_names": _SHARED_NAMES,
    "enrich_shared_names_sql": _SHARED_NAMES,
    "count_rows": "SELECT count(*) AS row_count FROM events",
    "batch_min_max": """
        SELECT min(ts) AS min_datestamp, max(ts) AS max_datestamp, count(*) AS row_count FROM events""",
    "distinct_ids": "SELECT DISTINCT user_id FROM events",
    "annual_metrics": f"WITH {_samples()} {_metrics('samples')}",
    "null_profile": """
        SELECT 0 AS position, 'l_orderkey' AS column_name, 'bigint' AS data_type, count(*) FILTER (l_orderkey IS NULL) AS null_count FROM lineitem
        UNION ALL SELECT 1, 'l_partkey', 'bigint', count(*) FILTER (l_partkey IS NULL) FROM lineitem
        UNION ALL SELECT 2, 'l_suppkey', 'bigint', count(*) FILTER (l_suppkey IS NULL) FROM lineitem
        UNION ALL SELECT 3, 'l_linenumber', 'int', count(*) FILTER (l_linenumber IS NULL) FROM lineitem
        UNION ALL SELECT 4, 'l_quantity', 'double', count(*) FILTER (l_quantity IS NULL) FROM lineitem
        UNION ALL SELECT 5, 'l_extendedprice', 'double', count(*) FILTER (l_extendedprice IS NULL) FROM lineitem
        UNION ALL SELECT 6, 'l_discount', 'double', count(*) FILTER (l_discount IS NULL OR l_discount = 0) FROM lineitem
        UNION ALL SELECT 7, 'l_tax', 'double', count(*) FILTER (l_tax IS NULL OR l_tax = 0) FROM lineitem
        UNION ALL SELECT 8, 'l_returnflag', 'string', count(*) FILTER (l_returnflag IS NULL OR l_returnflag = 'N') FROM lineitem
        UNION ALL SELECT 9, 'l_linestatus', 'string', count(*) FILTER (l_linestatus IS NULL) FROM lineitem
        UNION ALL SELECT 10, 'l_shipdate', 'timestamp_ntz', count(*) FILTER (l_shipdate IS NULL) FROM lineitem""",
    "preview_limit": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
    "except_all": "SELECT o_custkey FROM orders EXCEPT ALL SELECT user_id FROM events",
    "reconcile_ids": f"""
        WITH {_sites()}
        SELECT 'events' AS missing_in, SITE_ID FROM (SELECT SITE_ID FROM sites EXCEPT SELECT user_id FROM events)
        UNION ALL
        SELECT 'sites', user_id FROM (SELECT user_id FROM events EXCEPT SELECT SITE_ID FROM sites)""",
    "batch_ledger": f"""
        WITH {_ledger()}
        SELECT 'batch_' || batch AS version_id, min_datestamp, max_datestamp, 'Batch ' || batch AS description,
               'snapshots/year=' || year(min_datestamp) || '/batch_id=' || batch AS snapshot_path,
               row_count, CAST(0 AS BIGINT) AS corrupt_count
        FROM ledger""",
    "latest_batch": f"""
        WITH {_ledger()} SELECT batch AS batch_number, min_datestamp, max_datestamp FROM last_batch""",
    "latest_batch_slice": f"""
        WITH {_ledger()}
        SELECT orders.* FROM orders, last_batch
        WHERE o_orderdate >= min_datestamp AND o_orderdate <= max_datestamp""",
    "latest_batch_metrics": _LATEST_METRICS,
    "latest_batch_reconciliation": RECONCILIATION,
    "latest_sample_metrics": f"""
        WITH {_samples()}, {_sites()}, {_methods()},
        newest AS ({_newest("samples")}),
        joined AS ({_joined(_JOINED_METRIC_COLUMNS, "newest")})
        {_metrics("joined")}""",
    "report_saved": _LATEST_METRICS,
    "report_reconciliation_saved": RECONCILIATION,
    "check_not_empty": f"""
        SELECT 'metrics is not empty' AS check_name, count(*) > 0 AS passed, count(*) AS row_count
        FROM ({_LATEST_METRICS})""",
    "stream_json_ingest": _ALL_EVENTS,
    "stream_foreach_batch": _ALL_EVENTS,
    "stream_restart": _ALL_EVENTS,
    "stream_batch_ledger": """
        SELECT min(ts) AS min_datestamp, max(ts) AS max_datestamp, count(*) AS row_count,
               CAST(0 AS BIGINT) AS corrupt_count
        FROM events""",
    "stream_paced_replay": _ALL_EVENTS,
    "stream_replay_pace": "SELECT count(*) AS rows_sent, CAST(0 AS BIGINT) AS batches_above_pace FROM events",
    "stream_replay_batches": """
        WITH numbered AS (SELECT row_number() OVER () - 1 AS n FROM events)
        SELECT n // 5000 AS batch_number, count(*) AS row_count FROM numbered GROUP BY 1""",
    "stream_compacted_ledger": _ALL_EVENTS,
    "state_newest_rows": """
        SELECT * FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC NULLS LAST, o_orderkey DESC) = 1""",
    "state_yearly_metrics": f"""
        WITH {_samples()}, kept AS (SELECT * FROM samples WHERE SAMPLE_NO % 4 <> 1) {_metrics("kept")}""",
    "stream_progress": "SELECT count(*) AS rows_seen, CAST(0 AS BIGINT) AS untimed_batches FROM events",
}
