"""DuckDB oracle SQL for every registered query (same tables, same names)."""

from __future__ import annotations

from tributary.errors import EXIT_CODES
from tributary.plans import catalog as Q
from tributary.plans import fixtures as FX

TS = Q.DUCK_TS
TS_US = Q.DUCK_TS_US
ITEMS = FX.duck(FX.ITEMS_SQL)
CHANGES = FX.duck(FX.CHANGES_SQL)
ENTITY = FX.duck(FX.ENTITY_EDGES_SQL)
TRADE = FX.duck(FX.TRADE_SQL)
FLOWS = FX.duck(FX.FLOWS_SQL)
MAIL = FX.duck(FX.MAIL_SQL)
DAY_OF = "strftime(ts, '%Y-%m-%d')"


def _range_days(first: str, last: str) -> str:
    return (f"SELECT row_number() OVER (ORDER BY d) - 1 AS seq, strftime(d, '%Y-%m-%d') AS pv "
            f"FROM range(DATE '{first}', DATE '{last}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)")


RANGE_DAYS = _range_days(*Q.RANGE)
PATH = "split_part(pp, 'root:', 2)"
FULLPATH = f"CASE WHEN {PATH} <> '' THEN {PATH} || '/' || name ELSE name END"


def _values(rows) -> str:
    return ", ".join(rows)


ORACLES: dict[str, str] = {
    # ---- A
    "location_roundtrip": f"SELECT c_custkey, c_name, '{Q.OPAQUE_PV}' AS partition_value FROM customer",
    "partition_read": Q._days_sql(Q.DAY),
    "missing_partitions": f"""
        SELECT pv AS partition_value FROM ({RANGE_DAYS}) r
        WHERE pv NOT IN (SELECT DISTINCT {DAY_OF} FROM events)""",
    "partition_write": f"""
        SELECT {DAY_OF} AS partition_value,
               CAST(SUM(CASE WHEN {DAY_OF} <> '{Q.DAY}' OR event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n
        FROM events GROUP BY 1""",
    "landing_write": f"""
        SELECT {DAY_OF} || '-snowflake' AS landing_dir, event_id, strftime(ts, '{TS_US}') AS ts, user_id, event_type, value, props
        FROM events""",
    "csv_quarantine": f"""
        SELECT '{Q.OPAQUE_PV}' AS partition_value, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END AS c_custkey,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
               CASE WHEN c_acctbal < 0 THEN 'bad' || c_custkey || ',' || c_name || ',' || c_nationkey END AS rejected,
               count(*) FILTER (c_acctbal >= 0) OVER () AS n_rows, count(*) FILTER (c_acctbal < 0) OVER () AS n_rejected
        FROM customer""",
    "ingest_continue": f"""
        WITH d AS (SELECT {DAY_OF} AS partition_value, count(*) AS n FROM events GROUP BY 1)
        SELECT partition_value, CAST(1 AS INTEGER) AS attempt, CASE WHEN partition_value = '{Q.DAY}' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CASE WHEN partition_value <> '{Q.DAY}' THEN n END AS n_rows,
               CAST(CASE WHEN partition_value = '{Q.DAY}' THEN 1 ELSE 0 END AS INTEGER) AS exit_code, n AS n_landed,
               CASE WHEN partition_value <> '{Q.DAY}' THEN true END AS same_content FROM d
        UNION ALL SELECT partition_value, 2, 'SUCCESS', n, 0, n, true FROM d WHERE partition_value = '{Q.DAY}'""",
    "list_files": "SELECT doc_id || '.txt' AS name, CAST(strlen(text) AS BIGINT) AS length FROM documents",
    "count_files": "SELECT count(*) AS n_files FROM documents",
    "partition_names": """
        SELECT kind, o_orderpriority || ' 50%+a:b' AS partition_value, o_orderkey, o_totalprice
        FROM orders, (VALUES ('directory'), ('landing')) k(kind)""",
    "csv_documents": f"SELECT doc_id, text, lang, '{Q.OPAQUE_PV}' AS partition_value FROM documents",
    "csv_partition_read": """
        SELECT c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END AS c_custkey,
               c_nationkey, c_acctbal < 0 AS is_corrupt FROM customer""",
    "transport_step": Q._days_sql(Q.DAY),
    # ---- B
    "drive_list": f"SELECT id, name FROM ({ITEMS}) i",
    "item_listing": f"""
        SELECT id, name, type, CASE WHEN type = 'file' AND mime IS NOT NULL THEN mime ELSE '' END AS "mimeType",
               coalesce(dl, '') AS uri, {PATH} AS path, {FULLPATH} AS fullpath, name AS filename,
               coalesce(web, '') AS url
        FROM ({ITEMS}) i""",
    "item_weburl": f"SELECT id, coalesce(web, '') AS url FROM ({ITEMS}) i",
    "item_paths": f"SELECT id, {PATH} AS path, {FULLPATH} AS fullpath FROM ({ITEMS}) i",
    "folder_resolve": f"""
        WITH f AS (SELECT * FROM ({ITEMS}) i WHERE type = 'folder'),
             rq AS ({FX.duck(FX.RESOLVE_REQUESTS_SQL)})
        SELECT rq.event_id, rq.path,
               CASE len(string_split(rq.path, '/')) WHEN 1 THEN f1.id WHEN 2 THEN f2.id
                    WHEN 3 THEN f3.id END AS folder_id
        FROM rq
        LEFT JOIN f f1 ON f1.parent_id = 'root' AND f1.name = split_part(rq.path, '/', 1)
        LEFT JOIN f f2 ON f2.parent_id = f1.id AND f2.name = split_part(rq.path, '/', 2)
        LEFT JOIN f f3 ON f3.parent_id = f2.id AND f3.name = split_part(rq.path, '/', 3)""",
    "tree_walk": f"""
        WITH RECURSIVE it AS ({ITEMS}),
        w(id, parent_id, name, type, level, walk_path) AS (
            SELECT id, parent_id, name, type, 0, name FROM it WHERE parent_id = 'root'
            UNION ALL
            SELECT it.id, it.parent_id, it.name, it.type, w.level + 1, w.walk_path || '/' || it.name
            FROM it JOIN w ON it.parent_id = w.id WHERE w.type = 'folder')
        SELECT id, parent_id, name, type, CAST(level AS INTEGER) AS level, walk_path FROM w""",
    "fetch_outcomes": """
        SELECT d.doc_id,
               CAST(CASE WHEN p.page_id IS NOT NULL THEN 200 ELSE 404 END AS INTEGER) AS status,
               CASE WHEN p.page_id IS NOT NULL THEN 'OK' ELSE 'Not Found' END AS reason,
               CAST(strlen(p.html) AS BIGINT) AS length
        FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id * 3""",
    "fetch_by_id": f"""
        WITH it AS ({ITEMS}), rq AS ({FX.duck(FX.FETCH_REQUESTS_SQL)}),
        j AS (SELECT rq.*, it.id AS iid, it.name, it.type, it.pp, it.dl,
                     CASE WHEN instr(it.pp, ':/') > 0 THEN substr(it.pp, instr(it.pp, ':/') + 2) ELSE '' END AS sub
              FROM rq LEFT JOIN it ON rq.file_id = it.id)
        SELECT request_id, file_id, name, sub AS subfolder,
               CASE WHEN iid IS NOT NULL THEN
                    (CASE WHEN sub <> '' THEN '{Q.LOCAL_ROOT}/' || sub ELSE '{Q.LOCAL_ROOT}' END) || '/' || name
               END AS target_path,
               (iid IS NOT NULL AND type = 'file' AND dl IS NOT NULL) AS ok
        FROM j""",
    "download_manifest": f"""
        SELECT id, name,
               regexp_replace('{Q.LOCAL_ROOT}/' || ltrim({PATH}, '/'), '/+', '/', 'g') || '/' || name AS target_path,
               coalesce(dl, '') AS uri
        FROM ({ITEMS}) i WHERE type = 'file'""",
    "paged_source": f"""
        SELECT id, name, type, CASE WHEN type = 'file' AND mime IS NOT NULL THEN mime ELSE '' END AS "mimeType",
               coalesce(dl, '') AS uri, {PATH} AS path, {FULLPATH} AS fullpath, name AS filename
        FROM ({ITEMS}) i""",
    "remote_walk": f"""
        WITH RECURSIVE it AS ({ITEMS}),
        w(parent_id, id, name, type, pp, level) AS (
            SELECT parent_id, id, name, type, pp, 0 FROM it WHERE parent_id = 'root'
            UNION ALL
            SELECT it.parent_id, it.id, it.name, it.type, it.pp, w.level + 1
            FROM it JOIN w ON it.parent_id = w.id WHERE w.type = 'folder')
        SELECT parent_id, id, name, type, CAST(level AS INTEGER) AS level, {FULLPATH} AS fullpath FROM w""",
    # ---- C
    "message_table": f"""
        SELECT id, sender, 2 AS n_recipients, CASE WHEN cc1 IS NULL THEN 0 ELSE 1 END AS n_cc,
               0 AS n_bcc, epoch AS timestamp, body AS email FROM ({MAIL}) m""",
    "message_sender": f"SELECT id, sender FROM ({MAIL}) m",
    "message_recipients": f"""
        SELECT id, 0 AS pos, to1 AS recipient FROM ({MAIL}) m
        UNION ALL SELECT id, 1 AS pos, to2 AS recipient FROM ({MAIL}) m""",
    # ---- D
    "run_log_defaults": f"SELECT DISTINCT run_id, 'system' AS created_by, true AS has_created_at FROM ({CHANGES}) c",
    "run_log_exists": f"""
        SELECT r.run_id, coalesce(c.n, 0) AS n
        FROM ({FX.duck(Q.RUN_ID_REQUESTS_SQL)}) r
        LEFT JOIN (SELECT run_id, count(*) AS n FROM ({CHANGES}) x GROUP BY run_id) c ON r.run_id = c.run_id""",
    "run_log_upsert": f"""
        SELECT coalesce(c.run_id, b.run_id) AS run_id, b.step_name,
               coalesce(c.status, b.status) AS status,
               CASE WHEN c.unset LIKE '%start_ts%' THEN NULL ELSE strftime(b.start_ts, '{TS}') END AS start_ts,
               CASE WHEN c.unset LIKE '%params%' THEN NULL ELSE b.params END AS params,
               coalesce(c.error_message, b.error_message) AS error_message
        FROM ({FX.duck(Q.UPSERT_BASE_SQL)}) b
        FULL OUTER JOIN ({FX.duck(Q.UPSERT_CHANGES_SQL)}) c ON b.run_id = c.run_id""",
    "run_log_current": f"""
        SELECT run_id,
          arg_max(step_name, (ts, event_id)) FILTER (WHERE step_name IS NOT NULL) AS step_name,
          arg_max(status, (ts, event_id)) FILTER (WHERE status IS NOT NULL) AS status,
          arg_max(error_message, (ts, event_id)) FILTER (WHERE error_message IS NOT NULL) AS error_message,
          strftime(arg_max(start_ts, (ts, event_id)) FILTER (WHERE start_ts IS NOT NULL), '{TS}') AS start_ts,
          strftime(arg_max(end_ts, (ts, event_id)) FILTER (WHERE end_ts IS NOT NULL), '{TS}') AS end_ts,
          strftime(arg_max(last_updated_at, (ts, event_id)) FILTER (WHERE last_updated_at IS NOT NULL), '{TS}')
            AS last_updated_at,
          count(*) AS n_changes
        FROM ({CHANGES}) c GROUP BY run_id""",
    "status_counts": f"""
        SELECT CASE WHEN status IN ('QUEUED','PREPARING','VALIDATING','RUNNING','SUCCESS','FAILED',
                                    'BLOCKED','SKIPPED','UNKNOWN') THEN status ELSE 'UNKNOWN' END AS status,
               count(*) AS n
        FROM ({CHANGES}) c GROUP BY 1""",
    "run_id_parts": f"""
        SELECT DISTINCT run_id, split_part(run_id, '#$', 1) AS step, split_part(run_id, '#$', 2) AS suffix
        FROM ({CHANGES}) c""",
    "run_log_live": f"""
        SELECT event_id, strftime(ts + INTERVAL 1 YEAR, '{TS}') AS ttl FROM events
        WHERE ts + INTERVAL 1 YEAR > TIMESTAMP '{Q.AS_OF}'""",
    "run_duration": f"""
        SELECT user_id, strftime(s, '{TS}') AS start_ts, strftime(e, '{TS}') AS end_ts,
               printf('%02d:%02d:%02d', d // 3600, (d % 3600) // 60, d % 60) AS duration
        FROM (SELECT user_id, min(ts) AS s, max(ts) AS e, date_sub('second', min(ts), max(ts)) AS d
              FROM events GROUP BY user_id) g""",
    "job_summary": f"""
        WITH codes(code, name) AS (VALUES {_values(f"({c}, '{n}')" for c, n in EXIT_CODES)}),
        ch AS (
          SELECT c.*, CASE WHEN status = 'FAILED' THEN coalesce(codes.code, 1) END AS code,
                 lag(ts) OVER (PARTITION BY step_name ORDER BY ts) AS before
          FROM ({CHANGES}) c LEFT JOIN codes
          ON codes.name = [{", ".join(f"'{n}'" for n in Q.ERROR_NAMES)}][event_id % {len(Q.ERROR_NAMES)} + 1]
          WHERE ts IS NOT NULL),
        numbered AS (
          SELECT *, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL {Q.RUN_GAP} THEN 1 ELSE 0 END)
                    OVER (PARTITION BY step_name ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run_no
          FROM ch),
        g AS (
          SELECT step_name, CAST(run_no AS BIGINT) AS run_no, min(ts) AS s, max(ts) AS e, count(*) AS n_changes,
                 count(*) FILTER (status = 'FAILED') AS n_failed, max(code) AS code,
                 arg_max(status, (ts, event_id)) FILTER (status IS NOT NULL) AS last
          FROM numbered GROUP BY ALL)
        SELECT step_name, run_no, strftime(s, '{TS}') AS start_ts, strftime(e, '{TS}') AS end_ts, n_changes, n_failed,
               CAST(CASE WHEN n_failed > 0 THEN code WHEN last IN ('SUCCESS', 'FAILED', 'SKIPPED', 'BLOCKED') THEN 0 ELSE -1 END AS INTEGER) AS exit_code,
               printf('%02d:%02d:%02d', date_sub('second', s, e) // 3600,
                      (date_sub('second', s, e) % 3600) // 60, date_sub('second', s, e) % 60) AS duration
        FROM g""",
    "exit_codes": f"""
        WITH codes(code, name) AS (VALUES {_values(f"({c}, '{n}')" for c, n in EXIT_CODES)}),
        ev AS (SELECT event_id,
                      CASE WHEN event_type = 'error'
                           THEN [{", ".join(f"'{n}'" for n in Q.ERROR_NAMES)}][event_id % {len(Q.ERROR_NAMES)} + 1]
                      END AS error_name
               FROM events)
        SELECT ev.event_id, ev.error_name,
               CAST(CASE WHEN ev.error_name IS NULL THEN 0 ELSE coalesce(codes.code, 1) END AS INTEGER) AS exit_code
        FROM ev LEFT JOIN codes ON ev.error_name = codes.name""",
    "error_payload": """
        SELECT event_id, CAST(to_json({'status': -1, 'error': {'message': props}}) AS VARCHAR) AS error_message
        FROM events WHERE event_type = 'error'""",
    # ---- E
    "step_edges": f"SELECT DISTINCT parent_id AS src, id AS dst FROM ({ITEMS}) i WHERE parent_id <> 'root'",
    "edge_vetting": f"""
        SELECT src, dst, count(*) AS n_requests,
               CASE WHEN src = dst THEN 'self_loop' ELSE 'ok' END AS verdict,
               CASE WHEN src = dst THEN count(*) ELSE count(*) - 1 END AS n_rejected
        FROM ({TRADE}) t GROUP BY src, dst""",
    "edge_requests": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, src, dst,
               CASE WHEN src = dst THEN 'self_loop'
                    WHEN row_number() OVER (PARTITION BY src, dst
                                            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) = 1
                    THEN 'ok' ELSE 'duplicate' END AS verdict
        FROM ({TRADE}) t""",
    "step_levels": f"""
        WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM ({ENTITY}) x WHERE src <> dst),
        n AS (SELECT src AS node FROM e UNION SELECT dst FROM e),
        lv(node, lvl) AS (
            SELECT node, 0 FROM n WHERE node NOT IN (SELECT dst FROM e)
            UNION
            SELECT e.dst, lv.lvl + 1 FROM lv JOIN e ON e.src = lv.node)
        SELECT node, CAST(max(lvl) AS INTEGER) AS level FROM lv GROUP BY node""",
    "cycle_nodes": f"""
        WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM ({FLOWS}) x),
        n AS (SELECT src AS node FROM e UNION SELECT dst FROM e),
        r(a, b) AS (SELECT src, dst FROM e UNION SELECT r.a, e.dst FROM r JOIN e ON e.src = r.b),
        cyc AS (SELECT DISTINCT a AS node FROM r WHERE a = b),
        blocked AS (SELECT node FROM cyc UNION SELECT r.b FROM r JOIN cyc ON r.a = cyc.node)
        SELECT node, node IN (SELECT node FROM blocked) AS blocked, node IN (SELECT node FROM cyc) AS on_cycle FROM n""",
    "step_count": f"""
        SELECT count(*) AS n_steps FROM (SELECT src AS node FROM ({ENTITY}) a UNION SELECT dst FROM ({ENTITY}) b) n""",
    # ---- F
    "named_transform": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O'",
    "guarded_map": """
        SELECT doc_id, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS n_lines
        FROM documents WHERE n_chars % 7 <> 0""",
    "retrying_map": """
        SELECT doc_id, doc_id % 5 < 3 AS ok, CAST(least(doc_id % 5 + 1, 3) AS INTEGER) AS tries,
               CASE WHEN doc_id % 5 < 3
                    THEN CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) END AS n_lines
        FROM documents""",
    "observed_write": "SELECT count(*) AS n_rows, max(value) AS max_value FROM events",
    "ingest_outcomes": f"""
        WITH req AS ({_range_days(*Q.INGEST_RANGE)}),
        cnt AS (SELECT {DAY_OF} AS pv, count(*) AS n FROM events GROUP BY 1),
        j AS (SELECT req.seq, req.pv, cnt.n FROM req LEFT JOIN cnt ON req.pv = cnt.pv),
        stop AS (SELECT min(seq) AS s FROM j WHERE n IS NULL)
        SELECT CAST(seq AS INTEGER) AS seq, pv AS partition_value,
               CASE WHEN n IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               n AS n_rows, CAST(CASE WHEN n IS NULL THEN 2 ELSE 0 END AS INTEGER) AS exit_code
        FROM j, stop WHERE s IS NULL OR seq <= s""",
}

ORACLES["job_run_blocked"] = f"""
    WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS n_err
               FROM events WHERE {DAY_OF} = '{Q.DAY}')
    SELECT 'load' AS step, CAST(0 AS INTEGER) AS level, 'SUCCESS' AS status, n AS n_rows,
           CAST(0 AS INTEGER) AS exit_code FROM c
    UNION ALL SELECT 'side', 1, 'SUCCESS', n, 0 FROM c
    UNION ALL SELECT 'check', 1, CASE WHEN n_err > 0 THEN 'FAILED' ELSE 'SUCCESS' END,
                     CASE WHEN n_err > 0 THEN NULL ELSE n END, CASE WHEN n_err > 0 THEN 1 ELSE 0 END FROM c
    UNION ALL SELECT 'publish', 2, CASE WHEN n_err > 0 THEN 'BLOCKED' ELSE 'SUCCESS' END,
                     CASE WHEN n_err > 0 THEN NULL ELSE n END, CASE WHEN n_err > 0 THEN NULL ELSE 0 END FROM c"""

ORACLES["job_run"] = f"""
    SELECT step, CAST(level AS INTEGER) AS level, 'SUCCESS' AS status, n AS n_rows, CAST(0 AS INTEGER) AS exit_code
    FROM (SELECT count(*) AS n FROM events WHERE {DAY_OF} = '{Q.DAY}') c,
         (VALUES ('transport', 0), ('process', 1)) s(step, level)"""


def _contract_sql() -> str:
    types = {"l_orderkey": "bigint", "l_quantity": "double", "l_tax": "double"}
    parts = []
    for col, rules in Q.LINEITEM_CONTRACT.items():
        if col not in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                       "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"):
            parts.append(f"SELECT '{col}' AS \"column\", 'missing' AS rule, count(*) AS n_violations FROM lineitem")
            continue
        checks = []
        if "type" in rules:
            checks.append(("type", "TRUE" if types.get(col) != rules["type"] else "FALSE"))
        if rules.get("nullable") is False:
            checks.append(("not_null", f"{col} IS NULL"))
        if "min" in rules:
            checks.append(("min", f"{col} < CAST({rules['min']} AS DOUBLE)"))
        if "max" in rules:
            checks.append(("max", f"{col} > CAST({rules['max']} AS DOUBLE)"))
        if "values" in rules:
            vals = ", ".join(f"'{v}'" for v in rules["values"])
            checks.append(("values", f"{col} IS NOT NULL AND {col} NOT IN ({vals})"))
        for rule, cond in checks:
            parts.append(f"SELECT '{col}' AS \"column\", '{rule}' AS rule, "
                         f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS n_violations FROM lineitem")
    return "\nUNION ALL ".join(parts)


def _rules_sql() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(sum(CASE WHEN ({c}) THEN 1 ELSE 0 END) AS BIGINT) AS n_pass, "
        f"CAST(sum(CASE WHEN NOT ({c}) THEN 1 ELSE 0 END) AS BIGINT) AS n_fail, "
        f"CAST(sum(CASE WHEN ({c}) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unknown FROM lineitem"
        for name, c in Q.LINEITEM_RULES)


_CLOSED = "('SUCCESS', 'FAILED', 'SKIPPED', 'BLOCKED')"
_FOLDED = ", ".join(f"arg_max({c}, (ts, event_id)) FILTER ({c} IS NOT NULL) AS {c}" for c in
                    ("status", "error_message", "start_ts", "end_ts", "ts", "event_id", "user_id"))

ORACLES.update({
    "schema_contract": _contract_sql(),
    "validation_rules": _rules_sql(),
    "normalize_rejects": """
        SELECT 'o_orderpriority' AS "column", count(*) AS n_rejected FROM orders
        UNION ALL
        SELECT 'o_custkey' AS "column", count(*) AS n_rejected FROM orders WHERE o_orderstatus = 'P'
        HAVING count(*) > 0""",
    "incremental_load": f"""
        SELECT CAST(1 AS INTEGER) AS run, count(*) FILTER (WHERE {DAY_OF} <= '{Q.DAY}') AS n_new,
               count(*) FILTER (WHERE {DAY_OF} <= '{Q.DAY}') AS n_total FROM events
        UNION ALL
        SELECT CAST(2 AS INTEGER), count(*) FILTER (WHERE {DAY_OF} > '{Q.DAY}'), count(*) FROM events""",
    "run_log_rotate": f"""
        WITH c AS (SELECT * FROM ({CHANGES}) x),
        first AS (SELECT * FROM c WHERE {DAY_OF} <= '{Q.DAY}'),
        ended1 AS (SELECT run_id, {_FOLDED} FROM first GROUP BY run_id),
        open1 AS (SELECT * FROM first WHERE run_id NOT IN (SELECT run_id FROM ended1 WHERE status IN {_CLOSED})),
        second AS (SELECT * FROM open1 UNION ALL SELECT * FROM c WHERE {DAY_OF} > '{Q.DAY}'),
        ended2 AS (SELECT run_id, {_FOLDED} FROM second GROUP BY run_id),
        open2 AS (SELECT * FROM second WHERE run_id NOT IN (SELECT run_id FROM ended2 WHERE status IN {_CLOSED})),
        logs AS (
            SELECT 'history' AS log, * FROM ended1 WHERE status IN {_CLOSED}
            UNION ALL SELECT 'history', * FROM ended2 WHERE status IN {_CLOSED}
            UNION ALL SELECT 'current', run_id, status, error_message, start_ts, end_ts, ts, event_id, user_id FROM open2)
        SELECT log, run_id, status, error_message, strftime(start_ts, '{TS}') AS start_ts, strftime(end_ts, '{TS}') AS end_ts,
               strftime(ts, '{TS}') AS ts, event_id, user_id FROM logs""",
    "blocked_steps": f"""
        WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM ({ENTITY}) x WHERE src <> dst),
        f AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS node FROM supplier WHERE s_acctbal < 0),
        r(node) AS (SELECT e.dst FROM e JOIN f ON e.src = f.node
                    UNION SELECT e.dst FROM r JOIN e ON e.src = r.node)
        SELECT node FROM r WHERE node NOT IN (SELECT node FROM f)""",
})
