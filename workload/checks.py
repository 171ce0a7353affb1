"""SQL that says, for each query, what its result must be.

Written against the test tables only; nothing here is derived from the Spark plans.
"""

from __future__ import annotations

from outpour.contracts import CONTRACTS
from workload.fixtures import CONVERSIONS, LINE_CONVERSIONS, MEMBERSHIPS, SUBJECT_REQUESTS


def _plain(query: str) -> str:
    return query.replace("{", "").replace("}", "").strip()


MEM = f"mem AS ({_plain(MEMBERSHIPS)})"
DSR = f"dsr AS ({_plain(SUBJECT_REQUESTS)})"
CONV = f"conv AS ({_plain(CONVERSIONS)})"
LINES = f"lines AS ({_plain(LINE_CONVERSIONS)})"

FIELD = """CASE upper(id_type)
  WHEN 'TDID' THEN 'tdid' WHEN 'DAID' THEN 'daid' WHEN 'UID2' THEN 'uid2' WHEN 'UID2TOKEN' THEN 'uid2_token'
  WHEN 'EUID' THEN 'euid' WHEN 'EUIDTOKEN' THEN 'euid_token' WHEN 'RAMPID' THEN 'ramp_id' WHEN 'ID5' THEN 'id5'
  WHEN 'NETID' THEN 'net_id' WHEN 'FIRSTID' THEN 'first_id' WHEN 'MERKURYID' THEN 'merkury_id'
  WHEN 'IQVIAPPID' THEN 'iqvia_ppid' END"""

SENT_AT = "TIMESTAMP '2024-02-01 12:00:00'"
SENT_AGAIN_AT = "TIMESTAMP '2024-02-02 12:00:00'"
BAD = "event_id % 11 = 0"
SENDABLE = "id_type <> 'CoreID'"
MARK = "(SELECT max(ts) FROM events WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-16')"
OPTIONAL = """CAST(NULL AS VARCHAR) AS cookie_mapping_partner_id, CAST(NULL AS DOUBLE) AS bid_factor"""


def _time(column: str) -> str:
    return f"""strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"""


def _text(key: str, value: str) -> str:
    return f"""'"{key}":"' || {value} || '"'"""


def _number(key: str, value: str) -> str:
    return f"""'"{key}":' || {value}"""


def _object(*parts: str) -> str:
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


IDENTITY = f"""'"' || {FIELD} || '":"' || id_value || '"'"""

FIRST_PARTY_ITEM = _object(
    IDENTITY,
    """'"data":[' || """
    + _object(
        _text("name", "segment_name"),
        _text("timestamp_utc", _time("timestamp_utc")),
        _number("ttl_in_minutes", "ttl_in_minutes"),
        _number("base_bid_cpm", "base_bid_cpm"),
        _text("base_bid_cpm_metadata", "base_bid_cpm_metadata"),
    )
    + " || ']'",
)


def _status(code: str, message: str, failed: str) -> str:
    """Status columns of a row that can be sent, and of one that cannot."""
    return f"""
      ({SENDABLE}) AND NOT ({failed}) AS success,
      CASE WHEN NOT ({SENDABLE}) THEN 'UNKNOWN_ID_TYPE' WHEN {failed} THEN {code} END AS error_code,
      CASE WHEN NOT ({SENDABLE}) THEN 'not sent: UNKNOWN_ID_TYPE' WHEN {failed} THEN {message} END AS error_message,
      {SENT_AT} AS processed_timestamp"""


BAD_STATUS = _status("'BAD'", "'event ' || event_id", BAD)

# Batches of the rows that can be sent, 25 each, in blocks of 500 ids.
BATCHED = f"""{MEM}, batched AS (
  SELECT *, (row_number() OVER (PARTITION BY event_id // 500, {SENDABLE} ORDER BY event_id) - 1) // 25 AS batch_no
  FROM mem)"""

NUMBERED = """numbered AS (
  SELECT event_id, event_id // 500 AS bucket, place // 25 AS batch_no, CAST(place % 25 + 1 AS INTEGER) AS item_number
  FROM (SELECT event_id, row_number() OVER (PARTITION BY event_id // 500 ORDER BY event_id) - 1 AS place FROM events))"""

_LEDGER_OF = """ledger AS (
  SELECT event_type AS feed, max(ts) AS last_processed_date, max(ts) + INTERVAL 1 MINUTE AS run_timestamp,
    count(*) AS records_processed
  FROM events {where} GROUP BY event_type, CAST(ts AS DATE))"""
ALL_RUNS = _LEDGER_OF.format(where="")
LEDGER = _LEDGER_OF.format(where="WHERE ts < TIMESTAMP '2024-01-16'")

# Results of the first run, and of the second one with what failed in it.
RUNS = f"""{MEM}, first_run AS (SELECT *, {BAD_STATUS} FROM mem),
second_run AS (
  SELECT * EXCLUDE (success, error_code, error_message, processed_timestamp),
    error_code = 'BAD' AND event_id % 22 <> 0 AS success,
    CASE WHEN error_code <> 'BAD' THEN error_code WHEN event_id % 22 = 0 THEN 'BAD' END AS error_code,
    CASE WHEN error_code <> 'BAD' THEN error_message WHEN event_id % 22 = 0 THEN error_message END AS error_message,
    {SENT_AGAIN_AT} AS processed_timestamp
  FROM first_run WHERE NOT success),
runs AS (SELECT * FROM first_run UNION ALL SELECT * FROM second_run)"""

STATUS = "event_id, success, error_code, error_message, processed_timestamp"

CONVERSION_NULLS = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {field.name}"
    for field in CONTRACTS["conversion"].schema
    if field.name not in ("tracking_tag_id", "timestamp_utc", "order_id", "impression_id", "value", "td1")
    and field.name not in ("value_currency", "country", "user_ids", "line_items", "privacy_settings")
)

ORDER_ITEM = _object(
    _text("tracking_tag_id", "tracking_tag_id"),
    _text("timestamp_utc", _time("timestamp_utc")),
    """CASE WHEN o_orderkey % 4 = 2
         THEN '"user_id_array":[["0","c' || o_custkey || '"],["6","r' || o_custkey || '"]]'
       WHEN o_orderkey % 4 <> 0 THEN '"user_id_array":[["0","c' || o_custkey || '"]]' END""",
    *[_text(name, name) for name in ("order_id", "impression_id", "value", "value_currency", "country", "td1")],
)

LINE_ENTRY = _object(*[_text(k, v) for k, v in
                       dict(item_code="item_code", name="name", qty="qty", price="value", cat="cat").items()])
TAX_ENTRY = _object(_text("item_code", "'TAX'"), _text("qty", "'1'"), _text("price", "tax"))
PRIVACY_ENTRY = _object(
    _text("privacy_type", "'GDPR'"),
    _text("is_applicable", "CASE WHEN l_orderkey % 2 = 1 THEN 'true' ELSE 'false' END"),
    "CASE WHEN l_orderkey % 2 = 1 THEN " + _text("consent_string", "'consent' || l_orderkey") + " END",
)
LINE_ITEM = _object(
    _text("tracking_tag_id", "tracking_tag_id"),
    _text("timestamp_utc", _time("timestamp_utc")),
    _text("order_id", "order_id"),
    _text("value", "value"),
    f"""CASE WHEN l_linenumber NOT IN (6, 7) THEN '"line_items":[' || concat_ws(',', {LINE_ENTRY},
          CASE WHEN l_returnflag = 'R' THEN {TAX_ENTRY} END) || ']' END""",
    f"""'"privacy_settings":[' || {PRIVACY_ENTRY} || ']'""",
)

ENVELOPE_START = '{"data_provider_id":"prov1"'
ENVELOPE_END = (
    ',"data_load_trace_id":"trace-1","data_origins":'
    '[{"id":"crm","type":"Partner"},{"id":"outpour","type":"Integration"}]}'
)
FIRST_PARTY_ENVELOPE = (
    '{"advertiser_id":"adv1","data_provider_id":"prov1",'
    '"data_origins":[{"id":"outpour","type":"Integration"}]'
)

THIRD_PARTY_ENVELOPE = (
    '{"data_provider_id":"prov1","is_user_id_already_hashed":false,'
    '"data_origins":[{"id":"outpour","type":"Integration"}]'
)


def _three(sql: str) -> str:
    """The same rows for each of the three subject request destinations."""
    return " UNION ALL ".join(sql.replace("{contract}", n) for n in ("dsr_advertiser", "dsr_third_party", "dsr_merchant"))


CHECKS = {
    "conform_first_party": f"WITH {MEM} SELECT *, {OPTIONAL} FROM mem",
    "conform_third_party": f"""
        WITH {MEM} SELECT event_id, id_type, id_value, segment_name, ttl_in_minutes, updated_at, note,
          CAST(NULL AS VARCHAR) AS cookie_mapping_partner_id, CAST(NULL AS TIMESTAMP) AS timestamp_utc FROM mem""",
    "conform_dsr": f"WITH {DSR} " + _three("SELECT *, '{contract}' AS contract FROM dsr"),
    "conform_conversion": f"""
        WITH {CONV} SELECT *, {CONVERSION_NULLS},
          CASE WHEN o_orderkey % 4 = 2 THEN 2 WHEN o_orderkey % 4 <> 0 THEN 1 END AS user_ids_size,
          CAST(NULL AS INTEGER) AS line_items_size, CAST(NULL AS INTEGER) AS privacy_settings_size,
          CASE WHEN o_orderkey % 4 <> 0 THEN '[{{"type":"TDID","id":"c' || o_custkey || '"}}'
            || CASE WHEN o_orderkey % 4 = 2 THEN ',{{"type":"rampid","id":"r' || o_custkey || '"}}' ELSE '' END || ']'
          END AS user_ids FROM conv""",
    "conform_conversion_lines": f"""
        WITH {LINES} SELECT l_orderkey, l_linenumber, CAST(NULL AS VARCHAR) AS user_ids,
          CASE WHEN l_linenumber = 7 THEN '[]' WHEN l_linenumber <> 6 THEN '[' || concat_ws(',', {LINE_ENTRY},
            CASE WHEN l_returnflag = 'R' THEN {TAX_ENTRY} END) || ']' END AS line_items,
          '[' || {PRIVACY_ENTRY} || ']' AS privacy_settings FROM lines""",
    "drop_hidden_columns": f"WITH {MEM} SELECT * FROM mem",
    "id_normalize": f"WITH {MEM} SELECT event_id, id_type, {FIELD} AS id_field FROM mem",
    "id_quarantine": f"""
        WITH {MEM} SELECT event_id, id_type,
          CASE WHEN {SENDABLE} THEN '' ELSE 'UNKNOWN_ID_TYPE' END AS reasons FROM mem""",
    "contract_violations": f"""
        WITH {CONV}, judged AS (SELECT o_orderkey, concat_ws(',',
          CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 13 <> 0 THEN 'UNKNOWN_USER_ID_TYPE' END,
          CASE WHEN o_orderkey % 17 = 0 THEN 'NULL_TRACKING_TAG_ID' END,
          CASE WHEN o_orderkey % 13 = 0 THEN 'TOO_MANY_USER_IDS' END,
          CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 4 = 0
            AND impression_id IS NULL THEN 'NO_IDENTITY' END) AS reasons FROM conv)
        SELECT * FROM judged WHERE reasons <> ''""",
    "high_water_mark": f"WITH {ALL_RUNS} SELECT feed, max(last_processed_date) AS last_processed_date FROM ledger GROUP BY feed",
    "incremental_rows": f"WITH {MEM} SELECT * FROM mem WHERE updated_at > {MARK}",
    "incremental_first_run": f"WITH {MEM} SELECT * FROM mem",
    "incremental_override": f"WITH {MEM} SELECT * FROM mem WHERE updated_at > TIMESTAMP '2024-01-20'",
    "ledger_append": f"WITH {ALL_RUNS} SELECT * FROM ledger",
    "payload_first_party": f"""
        WITH {MEM} SELECT event_id, CASE WHEN {SENDABLE} THEN {FIRST_PARTY_ITEM} END AS item FROM mem""",
    "payload_third_party": f"""
        WITH {MEM} SELECT event_id, CASE WHEN {SENDABLE} THEN """
    + _object(
        IDENTITY,
        """'"data":[' || """
        + _object(
            _text("name", "segment_name"),
            _text("timestamp_utc", _time("timestamp_utc")),
            _number("ttl_in_minutes", "ttl_in_minutes"),
        )
        + " || ']'",
        "CASE WHEN event_id % 4 = 0 THEN " + _text("cookie_mapping_partner_id", "'p' || event_id") + " END",
    )
    + " END AS item FROM mem",
    "payload_dsr": f"WITH {DSR} "
    + _three(f"SELECT c_custkey, {_object(IDENTITY)} AS item, '{{contract}}' AS contract FROM dsr"),
    "payload_conversion": f"WITH {LINES} SELECT l_orderkey, l_linenumber, {LINE_ITEM} AS item FROM lines",
    "payload_conversion_orders": f"WITH {CONV} SELECT o_orderkey, {ORDER_ITEM} AS item FROM conv",
    "conversion_user_ids": """
        SELECT o_orderkey, 0 AS pos, '0' AS code, 'c' || o_custkey AS id FROM orders WHERE o_orderkey % 4 <> 0
        UNION ALL
        SELECT o_orderkey, 1, '6', 'r' || o_custkey FROM orders WHERE o_orderkey % 4 = 2""",
    "conversion_line_items": f"""
        WITH {LINES}
        SELECT l_orderkey, l_linenumber, 0 AS pos, {LINE_ENTRY} AS line_item
        FROM lines WHERE l_linenumber NOT IN (6, 7)
        UNION ALL
        SELECT l_orderkey, l_linenumber, 1, {TAX_ENTRY}
        FROM lines WHERE l_linenumber NOT IN (6, 7) AND l_returnflag = 'R'""",
    "conversion_privacy": """
        SELECT l_orderkey, l_linenumber, 0 AS pos, 'GDPR' AS privacy_type,
          CASE WHEN l_orderkey % 2 = 1 THEN 'true' ELSE 'false' END AS is_applicable,
          CASE WHEN l_orderkey % 2 = 1 THEN 'consent' || l_orderkey END AS consent_string
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "batch_numbers": f"""
        WITH {MEM}, {NUMBERED}
        SELECT event_id, id_value, bucket, batch_no, item_number FROM mem JOIN numbered USING (event_id)""",
    "batch_numbers_of_copies": """
        SELECT l_orderkey, l_orderkey // 500 AS bucket, place // 25 AS batch_no,
          CAST(place % 25 + 1 AS INTEGER) AS item_number
        FROM (SELECT l_orderkey,
          row_number() OVER (PARTITION BY l_orderkey // 500 ORDER BY l_orderkey) - 1 AS place FROM lineitem)""",
    "batch_numbers_global": """
        SELECT l_orderkey, l_returnflag, place // 25 AS batch_no, CAST(place % 25 + 1 AS INTEGER) AS item_number
        FROM (SELECT l_orderkey, l_returnflag, row_number() OVER (ORDER BY l_orderkey, l_returnflag) - 1 AS place
          FROM lineitem)""",
    "request_envelopes": f"""
        WITH {CONV}, batched AS (
          SELECT o_orderkey, o_orderkey // 500 AS bucket,
            (row_number() OVER (PARTITION BY o_orderkey // 500 ORDER BY o_orderkey) - 1) // 3 AS batch_no FROM conv)
        SELECT bucket, batch_no, CAST(count(*) AS INTEGER) AS items, bool_or(o_orderkey % 4 <> 0) AS has_user_ids,
          '{ENVELOPE_START}' || CASE WHEN bool_or(o_orderkey % 4 <> 0)
            THEN ',"user_id_array_metadata_format":["type","id"]' ELSE '' END || '{ENVELOPE_END}' AS envelope
        FROM batched GROUP BY bucket, batch_no""",
    "request_bodies": f"""
        WITH {BATCHED}
        SELECT event_id // 500 AS bucket, batch_no, CAST(count(*) AS INTEGER) AS items,
          '{FIRST_PARTY_ENVELOPE},"items":[' || string_agg({FIRST_PARTY_ITEM}, ',' ORDER BY event_id) || ']}}' AS body
        FROM batched WHERE {SENDABLE} GROUP BY event_id // 500, batch_no""",
    "request_bodies_third_party": f"""
        WITH {BATCHED}
        SELECT event_id // 500 AS bucket, batch_no, CAST(count(*) AS INTEGER) AS items,
          '{THIRD_PARTY_ENVELOPE},"items":[' || string_agg({_object(
              IDENTITY, """'"data":[' || """ + _object(_text("name", "segment_name")) + " || ']'"
          )}, ',' ORDER BY event_id) || ']}}' AS body
        FROM batched WHERE {SENDABLE} GROUP BY event_id // 500, batch_no""",
    "request_bodies_dsr": f"""
        WITH {DSR}, batched AS (
          SELECT *, (row_number() OVER (PARTITION BY c_custkey // 500 ORDER BY c_custkey) - 1) // 25 AS batch_no
          FROM dsr),
        envelopes (contract, envelope) AS (VALUES
          ('dsr_advertiser', '"advertiser_id":"adv1","request_type":"OptOut"'),
          ('dsr_third_party', '"data_provider_id":"prov1","request_type":"Deletion"'),
          ('dsr_merchant', '"merchant_id":7,"request_type":"Deletion"'))
        SELECT contract, c_custkey // 500 AS bucket, batch_no, CAST(count(*) AS INTEGER) AS items,
          FALSE AS has_user_ids, '{{' || envelope || ',"data_load_trace_id":"trace-2","items":['
            || string_agg({_object(IDENTITY)}, ',' ORDER BY c_custkey) || ']}}' AS body
        FROM batched CROSS JOIN envelopes GROUP BY contract, envelope, c_custkey // 500, batch_no""",
    "deliver_status": f"WITH {BATCHED} SELECT * EXCLUDE (batch_no), {OPTIONAL}, "
    + _status(
        f"CASE WHEN {BAD} THEN 'BAD' ELSE 'GEN' END",
        f"CASE WHEN {BAD} THEN 'event ' || event_id ELSE 'batch ' || batch_no END",
        f"({BAD} OR batch_no % 5 = 0)",
    )
    + " FROM batched",
    "deliver_map_column": f"""
        WITH {MEM} SELECT event_id, {BAD_STATUS},
          '{{"type":"' || segment_name || '","note":' || to_json(note) || '}}' AS tags FROM mem""",
    "deliver_in_arrival_order": f"WITH {MEM} SELECT *, {OPTIONAL}, {BAD_STATUS} FROM mem",
    "transient_failures": f"WITH {BATCHED} SELECT * EXCLUDE (batch_no), {OPTIONAL}, "
    + _status(
        "CASE batch_no % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Service Unavailable' WHEN 2 THEN 'HTTP 599' ELSE 'BAD' END",
        "CASE batch_no % 4 WHEN 0 THEN 'timed out' WHEN 1 THEN 'overloaded' WHEN 2 THEN 'odd' "
        "ELSE 'event ' || event_id END",
        f"(batch_no % 4 <> 3 OR {BAD})",
    )
    + " FROM batched",
    "adhoc_push": f"WITH {MEM} SELECT *, {OPTIONAL}, {BAD_STATUS} FROM mem",
    "adhoc_push_third_party": f"""
        WITH {MEM} SELECT event_id, id_type, id_value, segment_name,
          CAST(NULL AS VARCHAR) AS cookie_mapping_partner_id, CAST(NULL AS TIMESTAMP) AS timestamp_utc,
          CAST(NULL AS INTEGER) AS ttl_in_minutes, {_status("NULL", "NULL", "FALSE")} FROM mem""",
    "adhoc_push_dsr": f"WITH {DSR} "
    + _three(f"""SELECT *, TRUE AS success, CAST(NULL AS VARCHAR) AS error_code,
        CAST(NULL AS VARCHAR) AS error_message, {SENT_AT} AS processed_timestamp, '{{contract}}' AS contract FROM dsr"""),
    "adhoc_push_conversion": f"""
        WITH {CONV}, judged AS (SELECT *, o_orderkey % 4 = 0 AND impression_id IS NULL AS bare FROM conv)
        SELECT o_orderkey, value, NOT bare AS success, CASE WHEN bare THEN 'NO_IDENTITY' END AS error_code,
          CASE WHEN bare THEN 'not sent: NO_IDENTITY' END AS error_message, {SENT_AT} AS processed_timestamp
        FROM judged""",
    "request_keys": f"""
        WITH {BATCHED}, digests AS (
          SELECT event_id // 500 AS bucket, batch_no, event_id, sha256({FIRST_PARTY_ITEM}) AS digest
          FROM batched WHERE {SENDABLE}),
        keys AS (SELECT bucket, batch_no, sha256(concat_ws(chr(10), '{CONTRACTS["first_party"].path}',
            '{FIRST_PARTY_ENVELOPE}}}', string_agg(digest, chr(10) ORDER BY digest))) AS request_key
          FROM digests GROUP BY bucket, batch_no)
        SELECT event_id, request_key FROM digests JOIN keys USING (bucket, batch_no)""",
    "attribution_last_wins": f"""
        WITH {NUMBERED}, coded AS (SELECT *, CASE batch_no % 3
            WHEN 0 THEN CASE WHEN item_number = 2 THEN 'B' ELSE 'H' END
            WHEN 1 THEN CASE WHEN item_number = 5 THEN 'C' END END AS error_code FROM numbered)
        SELECT event_id, item_number, error_code IS NULL AS success, error_code,
          CASE error_code WHEN 'B' THEN 'second' WHEN 'H' THEN 'two' WHEN 'C' THEN 'last' END AS error_message
        FROM coded""",
    "attribution_null_error": f"""
        WITH {NUMBERED}
        SELECT event_id, item_number, batch_no % 3 = 2 AS success,
          CASE WHEN batch_no % 3 = 1 AND item_number <> 3 THEN 'G' END AS error_code,
          CASE WHEN batch_no % 3 = 1 AND item_number <> 3 THEN 'rest' END AS error_message
        FROM numbered""",
    "attribution_all_failed": """
        SELECT event_id, event_id // 8000 AS bucket, place // 1600 AS batch_no,
          CAST(place % 1600 + 1 AS INTEGER) AS item_number, FALSE AS success,
          CASE WHEN place % 1600 < 1500 THEN 'ITEM' ELSE 'GEN' END AS error_code,
          CASE WHEN place % 1600 < 1500 THEN 'item ' || (place % 1600 + 1) ELSE 'rest' END AS error_message
        FROM (SELECT event_id, row_number() OVER (PARTITION BY event_id // 8000 ORDER BY event_id) - 1 AS place
          FROM events)""",
    "attribution_out_of_range": f"""
        WITH {NUMBERED}
        SELECT bucket, batch_no, count(*) FILTER (WHERE item_number = 4) AS failed, count(*) AS items,
          CAST(1 + CAST(26 + batch_no > count(*) AS INTEGER) + CAST(count(*) < 4 AS INTEGER) AS INTEGER) AS strays
        FROM numbered GROUP BY bucket, batch_no""",
    "table_setup": f"WITH {MEM} SELECT * EXCLUDE (event_id, note), {OPTIONAL}, {BAD_STATUS} FROM mem",
    "table_setup_extra": f"""
        WITH {MEM} SELECT * REPLACE (CAST(ttl_in_minutes AS BIGINT) AS ttl_in_minutes), {OPTIONAL}, {BAD_STATUS} FROM mem""",
    "visible_results": f"WITH {MEM} SELECT *, {OPTIONAL}, {BAD_STATUS} FROM mem",
    "interval_marks": """
        WITH cells AS (
          SELECT date_trunc('hour', ts) AS from_date, count(*) AS records FROM events GROUP BY ALL
        ), begun AS (
          SELECT *, CASE WHEN from_date = lag(from_date) OVER (ORDER BY from_date) + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS begins
          FROM cells
        ), islands AS (SELECT *, sum(begins) OVER (ORDER BY from_date) AS island FROM begun)
        SELECT 'members' AS feed, min(from_date) AS from_date, max(from_date) + INTERVAL 1 HOUR AS to_date,
          CAST(sum(records) AS BIGINT) AS records
        FROM islands GROUP BY island""",
    "interval_rows": f"WITH {MEM} SELECT *, {OPTIONAL}, {BAD_STATUS} FROM mem",
    "results_append": f"""
        WITH {MEM} SELECT event_id, {BAD_STATUS} FROM mem
        UNION ALL
        SELECT event_id, * EXCLUDE (event_id, processed_timestamp), {SENT_AGAIN_AT} AS processed_timestamp
        FROM (SELECT {_status("NULL", "NULL", "FALSE")}, event_id FROM mem)""",
    "batch_run": f"WITH {MEM} SELECT *, {OPTIONAL}, {BAD_STATUS} FROM mem WHERE updated_at > {MARK}",
    "batch_run_ledger": f"""
        WITH {LEDGER} SELECT feed, last_processed_date, records_processed FROM ledger
        UNION ALL
        SELECT 'view', max(ts), count(*) FROM events WHERE ts > {MARK}""",
    "empty_run_ledger": f"""
        WITH {LEDGER} SELECT feed, last_processed_date, records_processed FROM ledger
        UNION ALL
        SELECT 'view', {MARK}, 0""",
    "fatal_run_results": f"""
        WITH {MEM} SELECT event_id, CAST({SENDABLE} AS BIGINT) AS delivered, 401 AS status, 1 AS refused FROM mem""",
    "live_strays": f"""
        WITH {BATCHED} SELECT count(*) AS records, count(*) FILTER (WHERE {SENDABLE}) AS succeeded,
          count(DISTINCT (event_id // 500, batch_no)) FILTER (WHERE {SENDABLE}) AS strays FROM batched""",
    "stream_increment": f"WITH {MEM} SELECT *, {OPTIONAL}, {BAD_STATUS} FROM mem",
    "stream_retry": f"""
        WITH {MEM}, sent AS (SELECT event_id, id_type, {BAD_STATUS} FROM mem)
        SELECT event_id, 1 AS attempt, success, error_code FROM sent
        UNION ALL SELECT event_id, 2, event_id % 22 <> 0, CASE WHEN event_id % 22 = 0 THEN 'BAD' END
        FROM sent WHERE error_code = 'BAD'
        UNION ALL SELECT event_id, 3, TRUE, NULL FROM sent WHERE error_code = 'BAD' AND event_id % 22 = 0""",
    "status_totals": f"""
        WITH {MEM}, sent AS (SELECT {BAD_STATUS} FROM mem)
        SELECT count(*) AS total, count(*) FILTER (WHERE success) AS succeeded,
          count(*) FILTER (WHERE NOT success) AS failed FROM sent""",
    "status_summary": f"""
        WITH {MEM}, sent AS (SELECT {BAD_STATUS} FROM mem)
        SELECT success, error_code, count(*) AS rows FROM sent GROUP BY success, error_code""",
    "failed_rows": f"""
        WITH {MEM}, sent AS (SELECT *, {OPTIONAL}, {BAD_STATUS} FROM mem) SELECT * FROM sent WHERE NOT success""",
    "succeeded_rows": f"""
        WITH {MEM}, sent AS (SELECT *, {OPTIONAL}, {BAD_STATUS} FROM mem) SELECT * FROM sent WHERE success""",
    "retry_set": f"""
        WITH {RUNS}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY processed_timestamp DESC) AS latest FROM runs)
        SELECT * EXCLUDE (latest), {OPTIONAL} FROM ranked WHERE latest = 1 AND NOT success""",
    "retry_users": f"""
        WITH {RUNS}, ranked AS (
          SELECT * REPLACE (timestamp_utc AS processed_timestamp), row_number() OVER (
            PARTITION BY id_type, id_value, segment_name ORDER BY timestamp_utc DESC) AS latest FROM first_run)
        SELECT id_type, id_value, segment_name, {STATUS} FROM ranked WHERE latest = 1 AND NOT success""",
    "replay_skip": f"""
        WITH {RUNS} SELECT * FROM mem WHERE NOT EXISTS (
          SELECT 1 FROM runs WHERE runs.event_id = mem.event_id AND runs.success)""",
    "replay_skip_updated": f"""
        WITH {RUNS}, changed AS (SELECT * REPLACE (
          CASE WHEN event_id % 3 = 0 THEN updated_at + INTERVAL 24 HOUR ELSE updated_at END AS updated_at) FROM mem)
        SELECT * FROM changed WHERE event_id % 3 = 0 OR NOT EXISTS (
          SELECT 1 FROM runs WHERE runs.event_id = changed.event_id AND runs.success)""",
    "replay_skip_pruned": f"""
        WITH {RUNS} SELECT * FROM mem WHERE updated_at > {MARK} AND NOT EXISTS (
          SELECT 1 FROM runs WHERE runs.event_id = mem.event_id AND runs.success
            AND runs.processed_timestamp >= {SENT_AGAIN_AT})""",
    "replay_skip_hot": f"WITH {MEM} SELECT * FROM mem WHERE segment_name NOT IN ('view', 'click')",
}
