"""DuckDB SQL of each registered query, written from the meaning and not from the Spark plan."""

from __future__ import annotations

from tallymark import schema as S
from tallymark.plans import views


def _select(select: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(views.columns(select))} FROM {source}"


_CUT = views.CUT.replace("TIMESTAMP_NTZ", "TIMESTAMP")
_WIDE_CUT = views.WIDE_CUT.replace("TIMESTAMP_NTZ", "TIMESTAMP")

_TEXT_ERROR = """CASE WHEN name = '' THEN 'name_empty'
    WHEN type NOT IN ('gauge', 'counter') THEN 'unsupported_type'
    WHEN raw_value = 'abc' THEN 'invalid_value' END"""
_TYPED_ERROR = """CASE WHEN type NOT IN ('gauge', 'counter') THEN 'unsupported_type'
    WHEN type = 'gauge' AND value IS NULL THEN 'value_required'
    WHEN type = 'counter' AND delta IS NULL THEN 'delta_required'
    WHEN name = '' THEN 'name_empty' END"""
_OWN_OPERANDS = """CASE WHEN type = 'gauge' THEN value END AS value,
    CASE WHEN type = 'counter' THEN delta END AS delta"""
_PARSED = """CASE WHEN type = 'gauge' THEN TRY_CAST(raw_value AS DOUBLE) END AS value,
    CASE WHEN type = 'counter' THEN TRY_CAST(raw_value AS BIGINT) END AS delta"""
_STATUS = """CASE error WHEN 'name_empty' THEN 404 WHEN 'not_found' THEN 404
    WHEN 'unsupported_type' THEN 400 WHEN 'invalid_value' THEN 400 ELSE 200 END"""
_SUM = "CAST(sum(delta) AS BIGINT)"
_FOLD = f"arg_max(value, seq) AS value, {_SUM} AS delta"
_SHOWN = """CASE WHEN type = 'gauge' THEN regexp_replace(CAST(value AS VARCHAR), '\\.0$', '')
    ELSE CAST(delta AS VARCHAR) END"""
_METRIC_JSON = """'{"id":"' || name || '","type":"' || type || '",' ||
    CASE WHEN type = 'gauge' THEN '"value":' || CAST(value AS VARCHAR)
    ELSE '"delta":' || CAST(delta AS VARCHAR) END || '}'"""

# Named inputs; a query gets those it needs and what they build on.
_WITH = {
    "raw": (_select(views.RAW, "events"), ()),
    "typed": (_select(views.TYPED, "events"), ()),
    "samples": (_select(views.SAMPLES, "events"), ()),
    "wide": (
        f"{_select(views.WIDE_GAUGES, 'orders')} UNION ALL BY NAME {_select(views.WIDE_COUNTERS, 'lineitem')}",
        (),
    ),
    "checked": (f"SELECT *, {_PARSED}, {_TEXT_ERROR} AS error FROM raw", ("raw",)),
    "valid": ("SELECT * EXCLUDE (error) FROM checked WHERE error IS NULL", ("checked",)),
    "identified": (
        """SELECT *, substr(t, 1, 8) || '-' || substr(t, 9, 4) || '-7' || substr(h, 1, 3) || '-' ||
            substr('89ab', CAST('0x' || substr(h, 4, 1) AS INTEGER) % 4 + 1, 1) || substr(h, 5, 3) || '-' || substr(h, 8, 12) AS id
        FROM (SELECT *, md5(CAST(seq AS VARCHAR)) AS h, lpad(lower(hex(epoch_us(ts) // 1000)), 12, '0') AS t FROM valid)""",
        ("valid",),
    ),
    "state": (f"SELECT type, name, {_FOLD} FROM valid GROUP BY ALL", ("valid",)),
    "base": (f"SELECT type, name, {_FOLD} FROM valid WHERE ts < {_CUT} GROUP BY ALL", ("valid",)),
    "new": (f"SELECT type, name, {_FOLD} FROM valid WHERE ts >= {_CUT} GROUP BY ALL", ("valid",)),
    "typed_checked": (f"SELECT * REPLACE ({_OWN_OPERANDS}), {_TYPED_ERROR} AS error FROM typed", ("typed",)),
    "verdicts": (
        """SELECT batch_id, coalesce(
            arg_min(error, seq) FILTER (WHERE error IS NOT NULL AND error <> 'name_empty'),
            arg_min(error, seq) FILTER (WHERE error IS NOT NULL)) AS error
        FROM typed_checked GROUP BY batch_id""",
        ("typed_checked",),
    ),
    "samples_long": (
        f"""SELECT poll_id, ts, unnest([{', '.join(f"'{n}'" for n in S.RUNTIME_NAMES)}]) AS name,
            unnest([{', '.join(S.RUNTIME_NAMES)}]) AS value FROM samples""",
        ("samples",),
    ),
    "samples_finite": (
        "SELECT poll_id, ts, name, CASE WHEN isfinite(value) THEN value ELSE 0 END AS value FROM samples_long",
        ("samples_long",),
    ),
    "ticked": (
        """SELECT *, greatest(1, CAST(ceil((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events))
            / 86400000000) AS BIGINT)) AS tick FROM valid""",
        ("valid",),
    ),
    "ticks": (
        """SELECT unnest(range(1, (SELECT CAST(ceil((max(epoch_us(ts)) - min(epoch_us(ts))) / 86400000000) AS BIGINT)
            FROM events) + 1)) AS tick""",
        ("ticked",),
    ),
    "cumulative": (
        f"""SELECT t.tick, u.type, u.name, arg_max(u.value, u.seq) AS value, CAST(sum(u.delta) AS BIGINT) AS delta
        FROM ticks t JOIN ticked u ON u.tick <= t.tick GROUP BY ALL""",
        ("ticks",),
    ),
    "asked": (
        """SELECT seq, CASE WHEN NOT broken THEN type END AS type, CASE WHEN NOT broken THEN name END AS name,
            CASE WHEN broken THEN 'malformed_json' END AS request_error
        FROM (SELECT *, seq % 59 = 11 OR seq % 71 = 6 OR seq % 73 = 8 AS broken FROM raw)""",
        ("raw",),
    ),
    "requests": (
        """SELECT DISTINCT type, name FROM raw WHERE name <> '' AND type <> 'histogram'
        UNION ALL SELECT 'gauge', 'Missing' UNION ALL SELECT 'hist', 'Any' UNION ALL SELECT 'gauge', ''""",
        ("raw",),
    ),
    "answered": (
        """SELECT q.type, q.name, s.value, s.delta,
            CASE WHEN q.type NOT IN ('gauge', 'counter') THEN 'unsupported_type'
                 WHEN s.name IS NULL THEN 'not_found' END AS error
        FROM requests q LEFT JOIN state s ON q.type = s.type AND q.name = s.name""",
        ("requests", "state"),
    ),
    "accepted": (
        """SELECT t.* FROM typed_checked t JOIN verdicts v ON t.batch_id = v.batch_id
        WHERE v.error IS NULL AND t.batch_id % 13 <> 4 AND t.batch_id % 17 <> 5 AND t.batch_id % 19 <> 6""",
        ("verdicts",),
    ),
}

_UPSERTED = """SELECT coalesce(n.type, b.type) AS type, coalesce(n.name, b.name) AS name,
    coalesce(n.value, b.value) AS value, {delta} AS delta
    FROM base b FULL JOIN new n ON b.type = n.type AND b.name = n.name"""
_ADDED = "CASE WHEN b.delta IS NOT NULL OR n.delta IS NOT NULL THEN coalesce(b.delta, 0) + coalesce(n.delta, 0) END"

_DOC_BROKEN = """(seq % 71 = 6 OR (seq % 83 <> 2 AND (
    (seq % 61 = 10 AND type <> 'gauge') OR (seq % 61 <> 10 AND raw_value = 'abc')
    OR (seq % 61 <> 10 AND type <> 'gauge' AND raw_value LIKE '%.%'))))"""
_DOC_VALUE = """CASE WHEN seq % 83 = 2 THEN NULL WHEN seq % 61 = 10 THEN 1.5
    ELSE TRY_CAST(raw_value AS DOUBLE) END"""
_DOC_DELTA = "CASE WHEN seq % 83 <> 2 THEN TRY_CAST(raw_value AS BIGINT) END"

# Query -> (SELECT, inputs).
_SQL = {
    "src_update_uri": (
        f"SELECT seq, type, name, raw_value, {_PARSED}, {_TEXT_ERROR} AS error FROM raw",
        ("raw",),
    ),
    "src_update_json": (
        f"""SELECT seq, type, name, {_OWN_OPERANDS}, CASE WHEN type IS NULL THEN 'malformed_json'
            ELSE {_TYPED_ERROR} END AS error
        FROM (SELECT seq, CASE WHEN NOT {_DOC_BROKEN} THEN type END AS type,
                CASE WHEN NOT {_DOC_BROKEN} THEN name END AS name,
                {_DOC_VALUE} AS value, {_DOC_DELTA} AS delta FROM raw)""",
        ("raw",),
    ),
    "src_updates_batch": (
        """SELECT t.batch_id, CAST(row_number() OVER (PARTITION BY t.batch_id ORDER BY seq) - 1 AS INTEGER) AS pos,
            type, name, value, delta, v.error
        FROM typed_checked t JOIN verdicts v ON t.batch_id = v.batch_id
        WHERE t.batch_id % 13 <> 4 AND t.batch_id % 17 <> 5 AND t.batch_id % 19 <> 6
        UNION ALL
        SELECT batch_id, NULL, NULL, NULL, NULL, NULL, 'malformed_json' FROM verdicts WHERE batch_id % 13 = 4""",
        ("verdicts",),
    ),
    "lookup_strict_json": ("SELECT * FROM asked", ("asked",)),
    "collect_unpivot": ("SELECT * FROM samples_long", ("samples_long",)),
    "collect_normalize": ("SELECT * FROM samples_finite", ("samples_finite",)),
    "collect_samples": (
        """SELECT poll_id, ts, 'gauge' AS type, name, value, CAST(NULL AS BIGINT) AS delta FROM samples_finite
        UNION ALL SELECT poll_id, ts, 'gauge', 'RandomValue',
            CAST(CAST('0x' || substr(md5('0:' || poll_id), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296, NULL FROM samples
        UNION ALL SELECT poll_id, ts, 'counter', 'PollCount', NULL, 1 FROM samples""",
        ("samples_finite",),
    ),
    "poll_count": (
        "SELECT 'counter' AS type, 'PollCount' AS name, count(*) AS delta FROM samples",
        ("samples",),
    ),
    "validate_updates": ("SELECT seq, type, name, raw_value, value, delta, error FROM checked", ("checked",)),
    "validate_typed": (
        "SELECT seq, batch_id, name, type, delta, value, error FROM typed_checked",
        ("typed_checked",),
    ),
    "validate_snapshot": (
        """SELECT seq, name AS id, type, value, delta, CASE WHEN name = '' THEN 'id_empty'
            WHEN type NOT IN ('gauge', 'counter') THEN 'unsupported_type'
            WHEN type = 'gauge' AND (value IS NULL OR delta IS NOT NULL) THEN 'operand_mismatch'
            WHEN type = 'counter' AND (delta IS NULL OR value IS NOT NULL) THEN 'operand_mismatch' END AS error
        FROM typed""",
        ("typed",),
    ),
    "rejects_by_code": (
        f"SELECT error, {_STATUS} AS status, count(*) AS n FROM checked WHERE error IS NOT NULL GROUP BY ALL",
        ("checked",),
    ),
    "batch_verdicts": ("SELECT * FROM verdicts", ("verdicts",)),
    "batch_atomic": (
        """SELECT batch_id, seq, type, name, value, delta FROM checked
        WHERE batch_id NOT IN (SELECT batch_id FROM checked WHERE error IS NOT NULL)""",
        ("checked",),
    ),
    "batch_profile": (
        """SELECT batch_id, count(*) AS n_items, count(*) FILTER (WHERE type = 'gauge') AS n_gauges,
            count(*) FILTER (WHERE type = 'counter') AS n_counters FROM checked GROUP BY batch_id""",
        ("checked",),
    ),
    "quality_report": (
        """SELECT name, CASE WHEN n = 0 THEN 'ok' WHEN name = 'overall' THEN 'unhealthy' ELSE 'error' END AS status,
            CASE WHEN n > 0 AND name <> 'overall' THEN n || ' rows' END AS error
        FROM (
            SELECT 'name_empty' AS name, count(*) FILTER (WHERE error = 'name_empty') AS n FROM checked
            UNION ALL SELECT 'unsupported_type', count(*) FILTER (WHERE error = 'unsupported_type') FROM checked
            UNION ALL SELECT 'invalid_value', count(*) FILTER (WHERE error = 'invalid_value') FROM checked
            UNION ALL SELECT 'name_too_long', count(*) FILTER (WHERE length(name) > 255) FROM checked
            UNION ALL SELECT 'type_too_long', count(*) FILTER (WHERE length(type) > 70) FROM checked
            UNION ALL SELECT 'time_missing', count(*) FILTER (WHERE ts IS NULL) FROM checked
            UNION ALL SELECT 'overall', count(error) FROM checked)""",
        ("checked",),
    ),
    "scalar_parse_format": (
        """SELECT l_extendedprice * 1000 AS number,
            regexp_replace(CAST(l_extendedprice * 1000 AS VARCHAR), '\\.0$', '') AS number_shown,
            regexp_replace(CAST(l_discount / 100 AS VARCHAR), '\\.0$', '') AS small_shown,
            l_orderkey AS int, CAST(NULL AS BIGINT) AS int_of_number, CAST(-l_orderkey AS VARCHAR) AS int_shown
        FROM lineitem""",
        (),
    ),
    "fold_gauges": (
        "SELECT name, arg_max(value, seq) AS value FROM valid WHERE type = 'gauge' GROUP BY name",
        ("valid",),
    ),
    "fold_counters": (f"SELECT name, {_SUM} AS delta FROM valid WHERE type = 'counter' GROUP BY name", ("valid",)),
    "fold_state": (
        f"SELECT type, name, {_FOLD}, min(ts) AS created_at, max(ts) AS updated_at FROM valid GROUP BY type, name",
        ("valid",),
    ),
    "fold_state_wide": (f"SELECT type, name, {_FOLD} FROM wide GROUP BY type, name", ("wide",)),
    "fold_ids": ("SELECT type, name, 'id_' || min(seq) AS id FROM valid GROUP BY type, name", ("valid",)),
    "fold_uuids": (
        """SELECT type, name, CASE WHEN type = 'gauge' THEN arg_max(id, seq) ELSE arg_min(id, seq) END AS id
        FROM identified GROUP BY type, name""",
        ("identified",),
    ),
    "latest_rows": (
        """SELECT seq, batch_id, name, type, raw_value, value, delta FROM valid
        QUALIFY row_number() OVER (PARTITION BY type, name ORDER BY seq DESC) = 1""",
        ("valid",),
    ),
    "assign_ids": ("SELECT seq, type, name, id FROM identified", ("identified",)),
    "state_upsert": (_UPSERTED.format(delta=_ADDED), ("base", "new")),
    "state_upsert_ids": (
        f"""SELECT type, name, arg_min(id, seq) AS id, coalesce(arg_max(value, seq) FILTER (WHERE ts >= {_CUT}), arg_max(value, seq)) AS value,
            {_SUM} AS delta, min(ts) AS created_at, max(ts) AS updated_at FROM identified GROUP BY type, name""",
        ("identified",),
    ),
    "state_upsert_wide": (
        f"""SELECT type, name, coalesce(arg_max(value, seq) FILTER (WHERE ts >= {_WIDE_CUT}), arg_max(value, seq)) AS value,
            {_SUM} AS delta FROM wide GROUP BY type, name""",
        ("wide",),
    ),
    "state_replace": (_UPSERTED.format(delta="coalesce(n.delta, b.delta)"), ("base", "new")),
    "state_merge_add": (_UPSERTED.format(delta=_ADDED), ("base", "new")),
    "key_violations": ("SELECT type, name, count(*) AS n FROM raw GROUP BY type, name HAVING count(*) > 1", ("raw",)),
    "rename_keys": (
        "SELECT type, CASE WHEN type = 'counter' THEN 'total_' || substr(name, 6) ELSE name END AS name, value, delta FROM state",
        ("state",),
    ),
    "state_scan": (
        f"SELECT type, name, {_FOLD}, min(ts) AS created_at, max(ts) AS updated_at FROM valid GROUP BY type, name ORDER BY type, name",
        ("valid",),
    ),
    "list_gauges": ("SELECT name, value FROM state WHERE type = 'gauge' ORDER BY name", ("state",)),
    "list_counters": ("SELECT name, delta FROM state WHERE type = 'counter' ORDER BY name", ("state",)),
    "list_state": (f"SELECT type, name, {_SHOWN} AS value FROM state ORDER BY type, name", ("state",)),
    "list_state_wide": (
        f"SELECT type, name, {_SHOWN} AS value FROM (SELECT type, name, {_FOLD} FROM wide GROUP BY type, name) ORDER BY type, name",
        ("wide",),
    ),
    "render_list": (f"SELECT type || ' ' || name || ' = ' || {_SHOWN} AS line FROM state ORDER BY type, name", ("state",)),
    "lookup_point": ("SELECT * FROM state WHERE type = 'gauge' AND name = 'val_click_3'", ("state",)),
    "lookup_many": (
        f"SELECT type, name, CASE WHEN error IS NULL THEN {_SHOWN} END AS value, error, {_STATUS} AS status FROM answered",
        ("answered",),
    ),
    "lookup_typed": (f"SELECT type, name, value, delta, error, {_STATUS} AS status FROM answered", ("answered",)),
    "lookup_json": (
        f"""SELECT seq, CASE WHEN error IS NULL THEN {_METRIC_JSON} END AS payload, error,
            CASE error WHEN 'not_found' THEN 404 ELSE CASE WHEN error IS NULL THEN 200 ELSE 400 END END AS status
        FROM (SELECT a.seq, a.type, a.name, s.value, s.delta, CASE WHEN request_error IS NOT NULL THEN request_error
                WHEN a.type NOT IN ('gauge', 'counter') THEN 'unsupported_type' WHEN a.name = '' THEN 'name_empty'
                WHEN s.name IS NULL THEN 'not_found' END AS error
            FROM asked a LEFT JOIN state s ON a.type = s.type AND a.name = s.name)""",
        ("asked", "state"),
    ),
    "sink_upsert": (_UPSERTED.format(delta=_ADDED), ("base", "new")),
    "sink_stream": (_UPSERTED.format(delta=_ADDED), ("base", "new")),
    "snapshot_array": (
        "SELECT CAST(row_number() OVER (ORDER BY type, name) - 1 AS INTEGER) AS pos, name AS id, type, value, delta FROM state",
        ("state",),
    ),
    "snapshot_save": ("SELECT name AS id, type, value, delta FROM state", ("state",)),
    "snapshot_load": ("SELECT name AS id, type, value, delta FROM state", ("state",)),
    "restore_state": (_UPSERTED.format(delta="coalesce(n.delta, b.delta)"), ("base", "new")),
    "wire_encode": (
        f"""SELECT seq, CASE WHEN error IS NULL THEN {_METRIC_JSON} END AS payload, error
        FROM (SELECT * REPLACE (CASE WHEN type NOT IN ('gauge', 'counter') THEN 'unsupported_type'
            WHEN raw_value = 'abc' THEN 'invalid_value' END AS error) FROM checked)""",
        ("checked",),
    ),
    "report_ticks": (
        """SELECT poll_id, poll_tick, CAST(ceil(poll_tick * 2 / 10) AS BIGINT) AS report_tick
        FROM (SELECT poll_id, greatest(1, CAST(ceil((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM samples))
            / 2000000) AS BIGINT)) AS poll_tick FROM samples)""",
        ("samples",),
    ),
    "report_cumulative": ("SELECT tick, type, name, value, delta FROM cumulative", ("cumulative",)),
    "report_range": (
        "SELECT tick, type, name, value, delta FROM cumulative WHERE tick BETWEEN (SELECT max(tick) FROM ticks) - 12 AND (SELECT max(tick) FROM ticks) - 3",
        ("cumulative",),
    ),
    "report_overcount": (
        "SELECT name, CAST(sum(delta) AS BIGINT) AS delta FROM cumulative WHERE type = 'counter' GROUP BY name",
        ("cumulative",),
    ),
    "report_payload": (
        f"""SELECT tick, CAST(0 AS BIGINT) AS part, '[' || string_agg({_METRIC_JSON}, ',' ORDER BY name, type) || ']' AS payload
        FROM cumulative GROUP BY tick""",
        ("cumulative",),
    ),
    "window_rollup": (
        f"""SELECT date_trunc('day', ts)::TIMESTAMP AS start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS "end",
            type, name, {_FOLD} FROM valid GROUP BY ALL""",
        ("valid",),
    ),
    "stream_fold": ("SELECT * FROM state", ("state",)),
    "stream_fold_state": ("SELECT * FROM state", ("state",)),
    "stream_fold_restored": (_UPSERTED.format(delta=_ADDED), ("base", "new")),
    "stream_upsert": (f"SELECT type, name, {_FOLD} FROM accepted GROUP BY type, name", ("accepted",)),
    "stream_snapshot": (
        f"SELECT name AS id, type, value, delta FROM (SELECT type, name, {_FOLD} FROM accepted GROUP BY type, name)",
        ("accepted",),
    ),
}


_SQL["quality_observed"] = _SQL["quality_report"]
_SQL["stream_batch_atomic"] = _SQL["batch_atomic"]
_SQL["stream_update_text"] = _SQL["stream_fold"]
_SQL["stream_update_json"] = (
    f"SELECT type, name, {_FOLD} FROM ({_SQL['src_update_json'][0]}) WHERE error IS NULL GROUP BY type, name", ("raw",)
)


def _inputs(names: tuple[str, ...], seen: dict[str, str]) -> dict[str, str]:
    for name in names:
        sql, needs = _WITH[name]
        _inputs(needs, seen)
        seen.setdefault(name, sql)
    return seen


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, (sql, needs) in _SQL.items():
        inputs = ",\n".join(f"{name} AS ({body})" for name, body in _inputs(needs, {}).items())
        out[key] = f"WITH {inputs}\n{sql}" if inputs else sql
    return out
