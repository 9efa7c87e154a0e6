"""What every registered query must return, in SQL over the bundled tables."""

from __future__ import annotations

from filetide.schema import LAYOUT

AS_OF = "TIMESTAMP '2001-07-01 00:00:00'"
ZERO_ID = "1751ac12e70e15b4f76c16775cd329ae"  # content id of a record with nothing in it


def _little_endian(x: str) -> str:
    digits = f"printf('%016x', {x})"
    return "||".join(f"substr({digits}, {i}, 2)" for i in range(15, 0, -2))


def _content_id(texts: list[str], numbers: list[str]) -> str:
    head = " || ".join(f"lower(hex({t})) || '00'" for t in texts)
    tail = " || ".join(_little_endian(n) for n in numbers)
    return f"substr(sha256(unhex({head} || {tail})), 1, 32)"


ACCESS = f"""
WITH delivered AS (
  SELECT *, UNNEST(CASE WHEN l_orderkey % 10 = 0 THEN [1, 2] ELSE [1] END) AS delivery
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  JOIN nation ON s_nationkey = n_nationkey
), valued AS (
  SELECT *, l_shipdate + to_seconds((l_orderkey * 7919) % 86400) AS event_time,
    CAST(l_quantity AS BIGINT) * 1048576 AS filesize, CAST(l_quantity AS BIGINT) AS quantity,
    'srv-' || l_suppkey AS server_id, s_name || ':1094' AS server,
    '/' || p_brand AS dirname1, '/' || p_brand || '/' || p_type AS dirname2,
    '/' || p_brand || '/' || p_type || '/' || l_orderkey || '-' || l_linenumber || '-' || l_partkey
      || '.dat' AS filename,
    CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS BIGINT) * 1048576 END AS "read",
    CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) * 1048576 ELSE 0 END AS "write"
  FROM delivered
), timed AS (
  SELECT *, CAST(epoch(event_time) AS BIGINT) AS second FROM valued
), access AS (
  SELECT *, event_time + to_minutes(delivery) AS ingest_time, s_name AS server_hostname,
    c_name AS "user", n_name AS site, dirname2 AS logical_dirname,
    CASE WHEN delivery = 2 AND l_orderkey % 100 = 0 THEN 'REVISED' ELSE c_mktsegment END AS vo,
    CASE WHEN l_linestatus = 'O' THEN 'primary' ELSE 'secondary' END AS source_exchange,
    CASE WHEN "write" > 0 THEN 'write' ELSE 'read' END AS operation,
    l_orderkey % 97 = 0 AS cut,
    {_content_id(["server_id", "server", "filename", "dirname2"],
                 ["second - 100", "second", "filesize", '"read"', "CAST(0 AS BIGINT)", '"write"',
                  "CAST(0 AS BIGINT)", "CAST(0 AS BIGINT)"])} AS event_id
  FROM timed
), final AS (
  SELECT * FROM access
  QUALIFY row_number() OVER (PARTITION BY server_hostname, event_time, event_id ORDER BY ingest_time DESC) = 1
)
"""

EVENTS = f"""
WITH delivered AS (
  SELECT *, UNNEST(CASE WHEN event_id % 10 = 0 THEN [1, 2] ELSE [1] END) AS delivery FROM events
), valued AS (
  SELECT date_trunc('millisecond', ts) AS event_time, event_id AS number, delivery, event_type,
    'srv-' || (user_id % 8) AS server_hostname, CAST(event_id AS VARCHAR) AS server_id,
    props AS filename, '/' || event_type AS dirname1, 'stream' AS source_exchange,
    CAST(round(value * 100) AS BIGINT) AS "read",
    CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END AS "write",
    CASE WHEN delivery = 2 AND event_id % 100 = 0 THEN 'REVISED' ELSE event_type END AS vo,
    event_id % 97 = 0 AS cut
  FROM delivered
), access AS (
  SELECT *, event_time + to_seconds(delivery) AS recv_time,
    CASE WHEN "write" > 0 THEN 'write' ELSE 'read' END AS operation,
    {_content_id(["server_id", "''", "filename", "''"],
                 ["CAST(0 AS BIGINT)"] * 3 + ['"read"', "CAST(0 AS BIGINT)", '"write"']
                 + ["CAST(0 AS BIGINT)"] * 2)} AS event_id
  FROM valued
), final AS (
  SELECT * FROM access
  QUALIFY row_number() OVER (PARTITION BY server_hostname, event_time, event_id ORDER BY recv_time DESC) = 1
)
"""

_NUMBERS = """CAST(count(*) AS BIGINT) AS events, CAST(sum("read") AS BIGINT) AS bytes_read,
  CAST(sum("write") AS BIGINT) AS bytes_written, CAST(count(DISTINCT filename) AS BIGINT) AS unique_files"""

_SERVER_IP = """CASE l_suppkey % 5
  WHEN 0 THEN '::ffff:10.1.2.' || (l_suppkey % 256)
  WHEN 1 THEN CASE WHEN l_suppkey % 256 = 0 THEN '2001:db8:0:0:1::'
              ELSE printf('2001:db8::1:0:0:%x', l_suppkey % 256) END
  WHEN 4 THEN '::ffff:10.1.2.' || (l_suppkey % 256)
  ELSE '::' END"""

_ACCESS_DIMS = "server_hostname, vo, source_exchange, operation, dirname1, dirname2"
_EVENT_DIMS = "server_hostname, vo, source_exchange, operation, dirname1, dirname1"


def _rollup(cte: str, rows: str, bucket: str, name: str, dims: str) -> str:
    named = dims.replace("operation, dirname1, dirname1", "operation, dirname1, dirname1 AS dirname2")
    return f"{cte} SELECT {bucket} AS {name}, {named}, {_NUMBERS} FROM {rows} GROUP BY ALL"


_HOUR = "date_trunc('hour', event_time)"
_DAY = "CAST(event_time AS DATE)"


def _usage(rows: str) -> str:
    return f"""{ACCESS} SELECT vo, {_NUMBERS} FROM {rows}
    WHERE {_HOUR} >= {AS_OF} - INTERVAL 7 DAY AND {_HOUR} < {AS_OF} GROUP BY vo"""


def _daily_since(days: int) -> str:
    return f"{_DAY} >= CAST({AS_OF} AS DATE) - {days} AND {_DAY} < {AS_OF}"


def _text(column: str) -> str:
    return f"CASE WHEN cut THEN '' ELSE {column} END AS \"{column}\""


def _number(column: str) -> str:
    return f"CAST(CASE WHEN cut THEN 0 ELSE {column} END AS BIGINT) AS \"{column}\""


_EVENT_VERSIONS = "server_hostname, event_time, event_id"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # Sources
    q["src1_read_messages"] = f"""{EVENTS} SELECT source_exchange, count(*) AS messages,
      min(recv_time) AS first_time, max(recv_time) AS last_time FROM access GROUP BY 1"""
    told = """to_json({'@timestamp': strftime(event_time, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(epoch_ms(event_time) % 1000 AS VARCHAR), 3, '0') || 'Z',
      'serverID': server_id, 'server_hostname': server_hostname, 'vo': vo, 'filename': filename, 'dirname1': dirname1,
      'dirname2': dirname1, 'read': "read", 'write': "write"})"""
    q["src1_message_bodies"] = f"""{EVENTS}, told AS (SELECT *, CAST({told} AS VARCHAR) AS whole FROM access)
      SELECT source_exchange, CASE WHEN cut THEN left(whole, length(whole) - 20) ELSE whole END AS body, recv_time FROM told"""
    zero = {"string": "''", "int": "CAST(0 AS INTEGER)", "bigint": "CAST(0 AS BIGINT)", "double": "CAST(0 AS DOUBLE)",
            "timestamp": "TIMESTAMP '1970-01-01 00:00:00'"}
    said = {"server_id": "server_id", "server_hostname": "server_hostname", "vo": "vo", "filename": "filename",
            "dirname1": "dirname1", "dirname2": "dirname1", "read": '"read"', "write": '"write"'}
    columns = {f.name: zero[f.dataType.simpleString()] for f in LAYOUT} | {"server_ip": "'::'"}
    columns |= {c: f"CASE WHEN cut THEN {columns[c]} ELSE {told_by} END" for c, told_by in said.items()}
    columns |= {"event_time": "CASE WHEN cut THEN recv_time ELSE event_time END", "source_exchange": "source_exchange",
                "event_id": f"CASE WHEN cut THEN '{ZERO_ID}' ELSE event_id END", "parse_error": "cut",
                "raw_json": "CASE WHEN cut THEN left(whole, length(whole) - 20) ELSE whole END"}
    q["nrm4_whole_layout"] = f"""{EVENTS}, told AS (SELECT *, CAST({told} AS VARCHAR) AS whole FROM access)
      SELECT {", ".join(f'{x} AS "{c}"' for c, x in columns.items())} FROM told"""
    q["src2_union_sources"] = f"{ACCESS} SELECT event_id, vo, source_exchange FROM access"
    q["src3_read_raw"] = f"""{EVENTS} SELECT event_time, event_id, vo, "read", "write" FROM access
      WHERE event_time >= TIMESTAMP '2024-01-05 06:00:00' AND event_time < TIMESTAMP '2024-01-20 18:30:00'"""
    q["src4_read_rollup"] = f"""{_rollup(EVENTS, "final", _HOUR, "hour", _EVENT_DIMS)
      .replace("FROM final", "FROM final WHERE " + _HOUR + " >= TIMESTAMP '2024-01-05 06:00:00' AND "
               + _HOUR + " < TIMESTAMP '2024-01-20 18:00:00'")}"""

    # Parse and normalise
    q["nrm1_parse_records"] = f"""{ACCESS} SELECT ingest_time AS recv_time, source_exchange,
      CASE WHEN cut THEN NULL ELSE filename END AS filename, CASE WHEN cut THEN NULL ELSE vo END AS vo,
      CASE WHEN cut THEN NULL ELSE second END AS end_time, CASE WHEN cut THEN NULL ELSE "read" END AS "read",
      CASE WHEN cut THEN NULL ELSE CAST(quantity - 25 AS INTEGER) END AS read_operations,
      CASE WHEN cut THEN NULL ELSE l_discount END AS read_vector_count_average,
      CASE WHEN cut THEN NULL ELSE l_linestatus = 'O' END AS ipv6 FROM access"""
    q["nrm2_parse_errors"] = f"""{ACCESS} SELECT source_exchange, cut AS parse_error, count(*) AS messages,
      count(*) FILTER (cut) AS empty_records FROM access GROUP BY ALL"""
    q["nrm3_event_time"] = f"""{ACCESS} SELECT ingest_time AS recv_time, filename,
      CASE WHEN l_linenumber % 4 = 0 THEN event_time
           WHEN l_linenumber % 4 = 1 THEN event_time
           WHEN l_linenumber % 4 = 2 THEN event_time - INTERVAL 100 SECOND
           ELSE ingest_time END AS event_time FROM access"""
    layout_texts = ["server_id", "server_hostname", "server", "site", "user", "vo", "filename",
                    "dirname1", "dirname2", "logical_dirname"]
    q["nrm4_project_layout"] = f"""{ACCESS} SELECT
      CASE WHEN cut THEN ingest_time ELSE event_time END AS event_time,
      CASE WHEN cut THEN '{ZERO_ID}' ELSE event_id END AS event_id, source_exchange, cut AS parse_error,
      {", ".join(_text(c) for c in layout_texts)}, '' AS token_groups,
      {", ".join(_number(c) for c in ("filesize", "read", "write"))},
      CAST(0 AS BIGINT) AS readv FROM access"""
    q["nrm5_unix_time"] = f"""{ACCESS} SELECT event_id, delivery, event_time AS end_time,
      event_time - INTERVAL 100 SECOND AS start_time, TIMESTAMP '1970-01-01 00:00:00' AS negative FROM access"""
    q["nrm6_unsigned_ranges"] = f"""{ACCESS} SELECT event_id, delivery,
      CAST(greatest(quantity - 25, 0) AS BIGINT) AS read_operations,
      CAST(least(greatest(CAST(trunc(l_extendedprice * 100000) AS BIGINT) - 1000000000, 0), 4294967295) AS BIGINT)
        AS operation_time,
      CAST(greatest(quantity - 10, 0) AS INTEGER) AS read_vector_count_min, filesize FROM access"""
    q["nrm7_flags"] = f"""{ACCESS} SELECT event_id, delivery,
      CAST((quantity * 8) & 255 AS INTEGER) AS has_file_close_msg,
      CAST(l_linestatus = 'O' AS INTEGER) AS ipv6 FROM access"""
    q["nrm8_server_ip"] = f"{ACCESS} SELECT event_id, delivery, {_SERVER_IP} AS server_ip FROM access"
    q["nrm9_event_id"] = f"{ACCESS} SELECT filename, delivery, event_time, event_id FROM access"
    q["nrm10_operation"] = f"""{ACCESS} SELECT operation, count(*) AS events,
      CAST(sum("write") AS BIGINT) AS bytes_written FROM access GROUP BY 1"""
    q["nrm11_buckets"] = f"""{ACCESS} SELECT event_id, delivery, {_HOUR} AS hour, {_DAY} AS day,
      strftime(event_time, '%Y%m%d') AS partition_day, strftime(event_time, '%Y%m') AS partition_month FROM access"""
    q["nrm12_json_string"] = f"""{ACCESS} SELECT event_id, delivery,
      CASE WHEN l_linestatus <> 'O' THEN filename ELSE '' END AS file_path,
      '' AS filesize_text FROM access"""

    # Dedup
    q["ddp1_dedup_latest"] = f"{ACCESS} SELECT event_id, vo, ingest_time FROM final"
    q["ddp2_raw_view"] = f"""{EVENTS} SELECT event_id, event_time, vo FROM final WHERE vo = 'view'"""
    q["ddp3_compact_raw"] = f"""{EVENTS} SELECT {_DAY} AS event_date, count(*) AS "rows",
      count(DISTINCT event_id) AS events FROM final GROUP BY 1"""
    q["ddp4_drop_recent_duplicates"] = f"{EVENTS} SELECT DISTINCT server_hostname, event_time, event_id FROM access"
    q["ddp4_by_arrival"] = f"""{EVENTS}, arrived AS (
        SELECT *, CAST(server_id AS BIGINT) AS number_, UNNEST(CASE WHEN CAST(server_id AS BIGINT) % 2 = 1 THEN [5]
          WHEN CAST(server_id AS BIGINT) % 10 = 0 THEN [0, 6] ELSE [0] END) AS hours FROM access WHERE delivery = 1)
      SELECT TIMESTAMP '2024-02-01 00:00:00' + to_hours(hours) AS recv_time, event_time, event_id, server_hostname, vo,
        filename, "read", "write", server_id AS raw_json FROM arrived"""
    q["ddp5_duplicate_report"] = f"""{ACCESS} SELECT server_hostname, event_time, event_id, count(*) AS copies
      FROM access GROUP BY ALL HAVING count(*) > 1"""
    q["ddp5_excess_by_source"] = f"""{ACCESS} SELECT source_exchange, count(*) AS "rows",
      (SELECT count(*) FROM final f WHERE f.source_exchange = a.source_exchange) AS final_rows,
      count(*) - (SELECT count(*) FROM final f WHERE f.source_exchange = a.source_exchange) AS excess
      FROM access a GROUP BY source_exchange"""

    # Sinks, layout, retention
    stored_day = "CAST(CASE WHEN cut THEN recv_time ELSE event_time END AS DATE)"
    q["snk1_write_raw"] = f"""{EVENTS} SELECT {stored_day} AS event_date, source_exchange, cut AS parse_error,
      count(*) AS "rows" FROM access GROUP BY ALL"""
    q["snk2_replayed_batches"] = f"""{EVENTS} SELECT {_DAY} AS event_date, vo, count(*) AS "rows",
      CAST(sum("read") AS BIGINT) AS bytes_read FROM access GROUP BY ALL"""
    q["snk3_later_copy_wins"] = f"""{EVENTS} SELECT count(*) FILTER (NOT cut) AS events,
      count(*) FILTER (NOT cut AND delivery = 2) AS from_second_delivery FROM final"""
    q["snk4_sorted_layout"] = f"""{EVENTS} SELECT event_time, event_id, vo FROM access
      WHERE server_hostname = 'srv-3' AND vo = 'click' AND event_time >= TIMESTAMP '2024-01-10 00:00:00'"""
    q["snk4_row_groups"] = f"""{EVENTS} SELECT layout, (SELECT count(*) FROM access) AS "rows", layout = 'stored' AS most_skipped
      FROM (SELECT UNNEST(['stored', 'unordered']) AS layout)"""
    q["snk5_bucketed_dedup"] = f"{EVENTS} SELECT event_id, event_time, vo FROM final"
    q["snk6_quarantine"] = f"""{EVENTS} SELECT source_exchange, CAST(recv_time AS DATE) AS event_date,
      count(*) AS "rows" FROM access WHERE cut GROUP BY ALL"""
    q["snk7_many_days"] = f"""{EVENTS} SELECT count(*) AS "rows", count(DISTINCT event_id) AS events,
      CAST(sum("read") AS BIGINT) AS bytes_read, true AS many_days, CAST(0 AS BIGINT) AS misplaced FROM access"""
    q["snk8_ensure_tables"] = f"""{EVENTS}, counted AS (
        SELECT (SELECT count(*) FROM access) AS copies, (SELECT count(*) FROM final) AS events)
      SELECT 'raw' AS "of", 'refreshed' AS step, copies AS n FROM counted
      UNION ALL SELECT 'raw', UNNEST(['interrupted', 'compacted']), events FROM counted
      UNION ALL SELECT 'rollup', UNNEST(['refreshed', 'interrupted', 'compacted']), events FROM counted"""
    q["snk9_two_jobs"] = f"""{EVENTS} SELECT {stored_day} AS event_date, source_exchange, 2 * count(*) AS "rows"
      FROM access GROUP BY ALL"""
    day_end = f"CAST({_DAY} AS TIMESTAMP) + INTERVAL 86399 SECOND"
    q["ret1_expire_raw"] = f"""{EVENTS} SELECT {_DAY} AS event_date, count(*) AS stored, nullif(count(*) FILTER (
        date_trunc('second', event_time) + INTERVAL 60 DAY > TIMESTAMP '2024-03-11 12:00:00'), 0) AS shown
      FROM final WHERE {day_end} + INTERVAL 60 DAY > TIMESTAMP '2024-03-11 12:00:00' GROUP BY 1"""
    q["ret2_expire_rollup"] = f"""{EVENTS} SELECT {_HOUR} AS hour, count(*) AS events,
      {_HOUR} + INTERVAL 2 YEAR > TIMESTAMP '2026-01-15 06:00:00' AS shown FROM final
      WHERE CAST({_DAY} AS TIMESTAMP) + INTERVAL 2 YEAR + INTERVAL 23 HOUR > TIMESTAMP '2026-01-15 06:00:00'
      GROUP BY 1"""
    q["ret3_longer_retention"] = f"""{EVENTS} SELECT {_DAY} AS event_date, count(*) AS "rows" FROM final
      WHERE {day_end} + INTERVAL 90 DAY > TIMESTAMP '2024-04-04 18:00:00' GROUP BY 1"""
    for again in ("refresh", "backfill"):
        q[f"ret4_late_{again}"] = f"""{EVENTS} SELECT {_HOUR} AS hour,
          count(*) + count(*) FILTER (event_time < TIMESTAMP '2024-01-09 00:00:00') AS events FROM final GROUP BY 1"""

    # Aggregation and rollups
    q["agg1_hourly_rollup"] = _rollup(ACCESS, "final", _HOUR, "hour", _ACCESS_DIMS)
    q["agg1_hourly_as_inserted"] = _rollup(ACCESS, "access", _HOUR, "hour", _ACCESS_DIMS)
    q["agg2_daily_rollup"] = _rollup(ACCESS, "final", _DAY, "day", _ACCESS_DIMS)
    q["agg3_count_states"] = f"{ACCESS} SELECT vo, operation, count(*) AS events FROM access GROUP BY ALL"
    q["agg4_sum_states"] = f"""{ACCESS} SELECT server_hostname, CAST(sum("read") AS BIGINT) AS bytes_read,
      CAST(sum("write") AS BIGINT) AS bytes_written FROM access GROUP BY 1"""
    q["agg5_distinct_states"] = f"""{ACCESS} SELECT vo, count(DISTINCT filename) AS unique_files
      FROM access GROUP BY 1"""
    q["agg1_hourly_by_server"] = _rollup(EVENTS, "final", _HOUR, "hour", "server_hostname, operation")
    q["agg2_daily_by_vo"] = _rollup(EVENTS, "final", _DAY, "day", "vo, source_exchange")
    q["agg5_exact_distincts"] = _rollup(EVENTS, "final", _DAY, "day", "vo")
    q["snk10_lost_drivers"] = _rollup(EVENTS, "final", _HOUR, "hour", "vo")
    q["agg6_incremental"] = _rollup(EVENTS, "access", _HOUR, "hour", _EVENT_DIMS)
    q["agg6_incremental_daily"] = _rollup(EVENTS, "access", _DAY, "day", _EVENT_DIMS)
    q["agg7_exact"] = _rollup(EVENTS, "final", _HOUR, "hour", _EVENT_DIMS)
    q["agg7_exact_daily"] = _rollup(EVENTS, "final", _DAY, "day", _EVENT_DIMS)
    q["agg7_many_days"] = f"""{EVENTS} SELECT vo, count(*) AS events, CAST(sum("read") AS BIGINT) AS bytes_read,
      CAST(sum("write") AS BIGINT) AS bytes_written FROM final GROUP BY 1"""
    q["agg8_compact_rollup"] = q["agg6_incremental"]
    q["agg9_backfill"] = f"""{EVENTS} SELECT CAST(date_trunc('week', event_time) AS DATE) AS week,
      server_hostname, vo, {_NUMBERS} FROM final GROUP BY ALL"""
    q["agg10_weekly_by_site"] = f"""{ACCESS} SELECT CAST(date_trunc('week', event_time) AS DATE) AS week, vo, site,
      count(*) AS events, CAST(sum(filesize) AS BIGINT) AS bytes_stored,
      count(DISTINCT "user") AS unique_users FROM final GROUP BY ALL"""
    q["agg11_count_by"] = f"""{ACCESS} SELECT source_exchange, vo, count(*) AS "rows" FROM access GROUP BY ALL"""

    # Read queries
    q["q1_usage_by_vo"] = _usage("final")
    q["q1_usage_by_vo_as_inserted"] = _usage("access")
    q["q2_server_series"] = f"""{ACCESS} SELECT {_HOUR} AS hour, CAST(sum("read") AS BIGINT) AS bytes_read FROM final
      WHERE server_hostname = 'Supplier#000000001' AND {_HOUR} >= {AS_OF} - INTERVAL 60 DAY AND {_HOUR} < {AS_OF}
      GROUP BY 1"""
    q["q3_top_servers"] = f"""{ACCESS} SELECT server_hostname, count(DISTINCT filename) AS unique_files,
      CAST(sum("read") AS BIGINT) AS bytes_read FROM final WHERE {_daily_since(30)} GROUP BY 1
      ORDER BY unique_files DESC, bytes_read DESC, server_hostname LIMIT 20"""
    q["q4_split_by_source_operation"] = f"""{ACCESS} SELECT source_exchange, operation, count(*) AS events,
      CAST(sum("read") AS BIGINT) AS bytes_read FROM final WHERE {_DAY} = CAST({AS_OF} AS DATE) - 1 GROUP BY ALL"""
    q["q5_top_directories"] = f"""{ACCESS} SELECT dirname1, dirname2, CAST(sum("read") AS BIGINT) AS bytes_read,
      count(*) AS events, count(DISTINCT filename) AS unique_files FROM final WHERE {_daily_since(7)} GROUP BY ALL
      ORDER BY bytes_read DESC, dirname1, dirname2 LIMIT 50"""
    q["q6_raw_spot_check"] = f"""{ACCESS} SELECT event_time, server_hostname, vo, filename, "read", "write" FROM final
      WHERE vo = 'BUILDING' AND event_time >= {AS_OF} - INTERVAL 1 DAY AND event_time < {AS_OF}
      ORDER BY event_time DESC, event_id LIMIT 100"""
    q["q7_recover_field"] = f"""{ACCESS} SELECT event_time, source_exchange, filename AS cache_file_path FROM access
      WHERE source_exchange = 'secondary' AND event_time >= {AS_OF} - INTERVAL 1 DAY AND event_time < {AS_OF}
      ORDER BY event_time, event_id, ingest_time DESC LIMIT 50"""
    q["q8_count_by_source"] = f"""{ACCESS} SELECT source_exchange, count(*) AS "rows" FROM access
      WHERE event_time > {AS_OF} - INTERVAL 1 HOUR AND event_time < {AS_OF} GROUP BY 1"""
    q["q9_count_final"] = f"""{ACCESS} SELECT count(*) AS "rows" FROM final"""

    # The same of stored tables
    at = "TIMESTAMP '2024-01-25 12:00:00'"
    since = lambda days: f"{_DAY} >= CAST({at} AS DATE) - {days} AND {_DAY} < {at}"
    lately = f"event_time >= {at} - INTERVAL 1 DAY AND event_time < {at}"
    q["q1_usage_by_vo_stored"] = f"""{EVENTS} SELECT vo, {_NUMBERS} FROM final
      WHERE {_HOUR} >= {at} - INTERVAL 7 DAY AND {_HOUR} < {at} GROUP BY vo"""
    q["q2_server_series_stored"] = f"""{EVENTS} SELECT {_HOUR} AS hour, CAST(sum("read") AS BIGINT) AS bytes_read FROM final
      WHERE server_hostname = 'srv-3' AND {_HOUR} >= {at} - INTERVAL 2 DAY AND {_HOUR} < {at} GROUP BY 1"""
    q["q3_top_servers_stored"] = f"""{EVENTS} SELECT server_hostname, count(DISTINCT filename) AS unique_files,
      CAST(sum("read") AS BIGINT) AS bytes_read FROM final WHERE {since(30)} GROUP BY 1
      ORDER BY unique_files DESC, bytes_read DESC, server_hostname LIMIT 20"""
    q["q4_split_by_source_operation_stored"] = f"""{EVENTS} SELECT source_exchange, operation, count(*) AS events,
      CAST(sum("read") AS BIGINT) AS bytes_read FROM final WHERE {_DAY} = CAST({at} AS DATE) - 1 GROUP BY ALL"""
    q["q5_top_directories_stored"] = f"""{EVENTS} SELECT dirname1, dirname1 AS dirname2,
      CAST(sum("read") AS BIGINT) AS bytes_read, count(*) AS events, count(DISTINCT filename) AS unique_files
      FROM final WHERE {since(7)} GROUP BY ALL ORDER BY bytes_read DESC, dirname1 LIMIT 50"""
    q["q6_raw_spot_check_stored"] = f"""{EVENTS} SELECT event_time, server_hostname, vo, filename, "read", "write" FROM final
      WHERE vo = 'view' AND {lately} ORDER BY event_time DESC, event_id LIMIT 100"""
    q["q7_recover_field_stored"] = f"""{EVENTS} SELECT event_time, source_exchange, dirname1 AS directory FROM access
      WHERE {lately} ORDER BY event_time, event_id, recv_time DESC LIMIT 50"""
    q["q8_count_by_source_stored"] = f"""{EVENTS} SELECT source_exchange, count(*) AS "rows" FROM access
      WHERE event_time > {at} - INTERVAL 1 DAY AND event_time < {at} GROUP BY 1"""
    q["q9_count_final_stored"] = f"""{EVENTS} SELECT count(*) AS "rows" FROM final"""

    # Pipeline metrics
    q["met1_batch_metrics"] = f"""{EVENTS} SELECT delivery, source_exchange,
      count(*) AS messages, count(*) FILTER (cut) AS parse_errors, count(*) AS rows_inserted,
      count(*) FILTER (cut) AS quarantined FROM access GROUP BY ALL"""
    q["met1_counters"] = f"""{EVENTS} SELECT CAST(count(*) AS BIGINT) AS messages,
      CAST(count(*) FILTER (cut) AS BIGINT) AS parse_errors, CAST(count(*) AS BIGINT) AS rows_inserted,
      CAST(count(*) FILTER (cut) AS BIGINT) AS quarantined FROM access"""
    q["met3_outcomes"] = q["met1_counters"].replace(
        " FROM access", ", CAST(2 AS BIGINT) AS batches_committed, CAST(1 AS BIGINT) AS insert_failures, "
        "CAST(2 AS BIGINT) AS timed_commits FROM access")
    bounds = ", ".join(f"CAST({0.005 * 2**i!r} AS DOUBLE)" for i in range(12)) + ", CAST('inf' AS DOUBLE)"
    q["met2_latency_histogram"] = f"""SELECT le, (SELECT count(*) FROM events WHERE value / 100.0 <= le) AS count
      FROM (SELECT UNNEST([{bounds}]) AS le)"""
    return q
