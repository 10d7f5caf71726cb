"""The same results in DuckDB's SQL, straight from the tables."""

from __future__ import annotations

import base64

from radiolake.functions.crypto import DEFAULT_KEY
from radiolake_checks.views import PACKET_FIELDS, PACKETS_SQL, SHORT_KEY, SOLO_KEY, WX_KEY

_P = f"WITH p AS ({PACKETS_SQL.format(events='events')})"

_MATCHES = "regexp_matches(topic, '^msh/[^/]*/[^/]*/[^/]*(/.*)?$')"
_NO_JSON = "NOT contains(topic, '/json/')"

# `port` is the port number after decryption: packets under a lost key stay unknown.
_HEARD = f"""{_P}, heard AS (
  SELECT *, CASE WHEN cipher = 'lost' THEN 0 ELSE portnum END AS port
  FROM p WHERE {_MATCHES} AND {_NO_JSON})"""

_PORT_NAME = """CASE port WHEN 0 THEN 'UNKNOWN_APP' WHEN 1 THEN 'FX_ONE' WHEN 3 THEN 'FX_THREE'
    WHEN 4 THEN 'NODEINFO_APP' END"""
_HW_NAME = "CASE hw_model WHEN 0 THEN 'UNSET' WHEN 1 THEN 'FX_HW_A' WHEN 2 THEN 'FX_HW_B' END"
_ROLE_NAME = "CASE role WHEN 0 THEN 'FX_CLIENT' WHEN 1 THEN 'FX_ROUTER' END"
_PART = "string_split(topic, '/')"
_KIND = f"{_PART}[4]"
_CHANNEL = f"""CASE WHEN {_PART}[5] IS NULL OR {_PART}[5] IN ('e', 'c') OR {_PART}[5] LIKE '!%'
    THEN '' ELSE {_PART}[5] END"""
_MAC = """CASE WHEN mac_hex = '' THEN NULL
    ELSE lower(regexp_replace(mac_hex, '(..)(..)(..)(..)(..)(..)', '\\1:\\2:\\3:\\4:\\5:\\6')) END"""


def _node_id(text: str) -> str:
    digits = f"nullif(regexp_extract({text}, '^!*0*([0-9a-fA-F]{{1,16}})$', 1), '')"
    return f"TRY_CAST(concat('0x', {digits}) AS BIGINT)"


_REASON = """CASE WHEN port IS NOT NULL AND portnum_name IS NULL THEN 'portnum has no name'
    WHEN rx_time > 2147483647 THEN 'rx_time out of range' END"""

# A node description's payload and a stored message are shown by the fields they parse to.
_USER_SHOWN = """CASE WHEN bad_user THEN '' ELSE concat_ws('|', user_id, long_name, short_name, hw_model, role,
    is_licensed, mac_hex) END"""
_MESSAGE_SHOWN = f"""concat_ws('|', gateway_id, channel_id, from_node_id, to_node_id, mesh_packet_id, rssi,
    {', '.join(PACKET_FIELDS)}, cipher <> 'plain')"""

# The 29 columns.
_ROWS = f"""{_HEARD}, rows_ AS (
  SELECT seq, ingest_ts AS "timestamp", topic, from_node_id, to_node_id, port, port AS portnum,
    {_PORT_NAME} AS portnum_name, gateway_id, channel_id, mesh_packet_id, rssi, snr,
    CASE WHEN port = 4 THEN 0 WHEN failed OR cipher = 'lost' THEN 0 ELSE strlen(text) END AS payload_length,
    CASE WHEN port = 4 THEN {_USER_SHOWN} WHEN failed OR cipher = 'lost' THEN '' ELSE hex(text) END AS raw_payload,
    NOT failed AS processed_successfully, {', '.join(PACKET_FIELDS)},
    {_KIND} AS message_type,
    CASE WHEN failed THEN '0A05' ELSE {_MESSAGE_SHOWN} END AS raw_service_envelope,
    CASE WHEN failed THEN 'Parsing error: ' END AS parsing_error
  FROM heard), judged AS (SELECT *, {_REASON} AS reject_reason FROM rows_)"""

_COLUMNS = f""""timestamp", topic, from_node_id, to_node_id, portnum, portnum_name, gateway_id,
  channel_id, mesh_packet_id, rssi, snr, payload_length, raw_payload, processed_successfully,
  {', '.join(PACKET_FIELDS)}, message_type, raw_service_envelope, parsing_error"""

_FIRST = """mesh_packet_id IS NULL OR gateway_id IS NULL
  OR row_number() OVER (PARTITION BY mesh_packet_id, gateway_id ORDER BY {order}) = 1"""

_HISTORY = f"""{_ROWS}, stored AS (SELECT * FROM judged WHERE reject_reason IS NULL)
SELECT {_COLUMNS} FROM stored QUALIFY {_FIRST.format(order='"timestamp", seq')}"""

_GATEWAYS = f"""SELECT {_node_id('gateway_id')} AS node_id, gateway_id AS hex_id,
    CAST(NULL AS VARCHAR) AS long_name, CAST(NULL AS VARCHAR) AS short_name,
    CAST(NULL AS VARCHAR) AS hw_model, CAST(NULL AS VARCHAR) AS role,
    CAST(NULL AS VARCHAR) AS primary_channel, CAST(NULL AS BOOLEAN) AS is_licensed,
    CAST(NULL AS VARCHAR) AS mac_address, ingest_ts AS first_seen, ingest_ts AS last_updated,
    seq, 0 AS step
  FROM heard WHERE gateway_id <> '' AND {_node_id('gateway_id')} IS NOT NULL"""

_NODEINFO = f"""SELECT from_node_id AS node_id, nullif(user_id, '') AS hex_id,
    nullif(long_name, '') AS long_name, nullif(short_name, '') AS short_name,
    replace({_HW_NAME}, 'UNSET', 'Unknown') AS hw_model, {_ROLE_NAME} AS role,
    channel_id AS primary_channel, is_licensed, {_MAC} AS mac_address,
    ingest_ts AS first_seen, ingest_ts AS last_updated, seq, 1 AS step
  FROM heard WHERE port = 4 AND NOT bad_user
    AND {_HW_NAME} IS NOT NULL AND {_ROLE_NAME} IS NOT NULL"""

_CHANGES = f"{_HEARD}, changes AS ({_GATEWAYS} UNION ALL {_NODEINFO})"

_VALUES = (
    "hex_id",
    "long_name",
    "short_name",
    "hw_model",
    "role",
    "primary_channel",
    "is_licensed",
    "mac_address",
)

# `seq` follows arrival in the fixture, so it orders the changes together with the step.
_LAST = ", ".join(
    f"arg_max({c}, seq * 2 + step) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _VALUES
)
_FOLD = f"""SELECT node_id, {_LAST}, min(first_seen) AS first_seen, max(last_updated) AS last_updated
FROM changes GROUP BY node_id"""
_NODES = f"{_CHANGES} {_FOLD}"

_MESSAGES = f"{_P} SELECT topic, hex(text) AS payload, ingest_ts, {{seq}} AS seq FROM p"


def _blob(key: bytes) -> str:
    return f"unhex('{key.hex()}')"


def _named(key: bytes, channel: str) -> str:
    return f"upper(sha256({_blob(key)} || encode({channel})))"


def _bound(key: bytes) -> str:
    return f"CASE WHEN channel <> '' THEN {_named(key, 'channel')} END"


_DEFAULT = base64.b64decode(DEFAULT_KEY)
_CANDIDATES = ", ".join(
    [
        f"'{_DEFAULT.hex().upper()}'",
        _bound(_DEFAULT),
        f"'{WX_KEY.hex().upper()}'",
        _bound(WX_KEY),
        _named(WX_KEY, "'Wx'"),
        f"'{SHORT_KEY.hex().upper()}'",
        _bound(SHORT_KEY),
        f"'{SOLO_KEY.hex().upper()}'",
        _bound(SOLO_KEY),
        _named(SOLO_KEY, "'Solo'"),
    ]
)

# Ciphertexts of the golden vectors, FIXTURES.md section 5.
_GOLDEN_RAW = "A3A2399282716F39A1DD9A095BC7FD85EA119EF6AC5379AF3A70A40F4D1B0EC14E6E2309499B918A"
_GOLDEN_BOUND = "D06F25C6A5945D2E0DED14D41BE662CC4FDB6AF8CFAAA8D9F6835540BE60B8FC7AAF101144A05BFA"

_SHOWN = "seq, topic, mesh_packet_id, gateway_id, from_node_id, portnum"

_NEW = f"""{_HEARD}, history AS (SELECT * FROM heard WHERE ingest_ts < TIMESTAMP '2024-01-16')
SELECT {_SHOWN} FROM heard b WHERE ingest_ts >= TIMESTAMP '2024-01-16' AND NOT EXISTS (
  SELECT 1 FROM history h WHERE h.mesh_packet_id = b.mesh_packet_id AND h.gateway_id = b.gateway_id)"""


_KEPT = f"""{_HEARD} SELECT mesh_packet_id, gateway_id,
  CASE WHEN mesh_packet_id IS NULL OR gateway_id IS NULL THEN count(*) ELSE 1 END AS kept
FROM heard GROUP BY mesh_packet_id, gateway_id"""


def all_sql() -> dict[str, str]:
    return {
        "o01_read_messages": _MESSAGES.format(seq="seq"),
        "o01_read_messages_stream": _MESSAGES.format(seq="seq"),
        "o01_messages_from_kafka": _MESSAGES.format(
            seq="((seq // 8) * 65536 + seq // 2 % 4) * 2 + seq % 2"
        ),
        "o02_append_history": _HISTORY,
        "o02_append_rejected": f"""{_ROWS} SELECT "timestamp", topic, from_node_id, portnum,
            gateway_id, mesh_packet_id, reject_reason FROM judged WHERE reject_reason IS NOT NULL""",
        "o03_write_nodes": _NODES,
        "o04_conform": f"{_ROWS} SELECT {_COLUMNS} FROM judged WHERE reject_reason IS NULL",
        "o05_topic_matches": f"{_P} SELECT seq, topic FROM p WHERE {_MATCHES}",
        "o05_topic_patterns": f"""{_P} SELECT seq, regexp_matches(topic, '^msh/[^/]*/2/e(/.*)?$') AS one,
            regexp_matches(topic, '^msh/EU_868/[^/]*/c/LongFast/[^/]*$') AS two,
            regexp_matches(topic, '^[^/]*/[^/]*/stat$') AS three, true AS four FROM p""",
        "o06_skip_json": f"{_P} SELECT seq, topic FROM p WHERE {_NO_JSON}",
        "o07_is_encrypted": f"""{_P} SELECT seq,
            CASE WHEN NOT failed THEN cipher <> 'plain' END AS encrypted FROM p""",
        "o08_is_nodeinfo": f"{_HEARD} SELECT seq, from_node_id FROM heard WHERE port = 4",
        "o09_has_gateway": f"""{_P} SELECT seq, gateway_id FROM p
            WHERE gateway_id <> '' AND {_node_id('gateway_id')} IS NOT NULL""",
        "o10_storable": f"""{_ROWS} SELECT seq, portnum, portnum_name, rx_time FROM judged
            WHERE reject_reason IS NULL""",
        "o10_rejected": f"""{_ROWS} SELECT seq, portnum, rx_time, reject_reason FROM judged
            WHERE reject_reason IS NOT NULL""",
        "o11_decode_envelope": f"""{_P} SELECT seq, failed, gateway_id, channel_id, from_node_id,
            to_node_id, mesh_packet_id, CASE WHEN cipher = 'plain' THEN portnum ELSE 0 END AS portnum,
            rssi, snr, {', '.join(PACKET_FIELDS)} FROM p""",
        "o12_decode_data": f"""{_P} SELECT seq, CASE WHEN portnum <> 0 THEN 3 END AS rank,
            CASE WHEN portnum <> 0 THEN portnum END AS portnum,
            CASE WHEN portnum NOT IN (0, 4) THEN text END AS text,
            CASE WHEN portnum <> 0 THEN true END AS same_payload FROM p""",
        "o13_decode_user": f"""{_P} SELECT seq, CASE WHEN NOT bad_user THEN user_id END AS user_id,
            CASE WHEN NOT bad_user THEN long_name END AS long_name,
            CASE WHEN NOT bad_user THEN short_name END AS short_name,
            CASE WHEN NOT bad_user THEN hw_model END AS hw_model,
            CASE WHEN NOT bad_user THEN role END AS role,
            CASE WHEN NOT bad_user THEN is_licensed END AS is_licensed,
            CASE WHEN NOT bad_user THEN mac_hex END AS mac_hex FROM p""",
        "o14_candidate_keys": f"""{_P}, c AS (SELECT seq, {_CHANNEL} AS channel FROM p)
            SELECT seq, concat_ws(',', {_CANDIDATES}) AS candidates FROM c""",
        "o15_derive_key": """SELECT doc_id,
            CASE WHEN source <> '' THEN upper(sha256(encode(text) || encode(source)))
                 ELSE hex(encode(text)) END AS channel_key,
            hex(encode(text)) AS plain_key, repeat('0', 64) AS bad_key FROM documents""",
        "o16_aes_ctr": f"""SELECT doc_id, text, strlen(text) AS sealed_bytes, true AS differs,
            '{_GOLDEN_RAW}' AS golden_raw, '{_GOLDEN_BOUND}' AS golden_bound FROM documents""",
        "o17_decrypt_packets": f"""{_P} SELECT seq,
            CASE WHEN cipher = 'lost' THEN 0 ELSE portnum END AS portnum,
            CASE WHEN cipher = 'lost' THEN '' WHEN failed OR portnum = 4 THEN NULL ELSE text END AS text,
            CASE WHEN portnum = 4 AND cipher <> 'lost' AND NOT bad_user THEN long_name END AS long_name,
            CASE WHEN portnum = 4 AND cipher <> 'lost' AND NOT bad_user THEN hw_model END AS hw_model
            FROM p""",
        "o18_packet_rows": f"""{_ROWS}
            SELECT {_COLUMNS.replace(', parsing_error', '').replace(' processed_successfully,', '')}
            FROM judged""",
        "o19_status_columns": f"""{_P} SELECT seq, NOT failed AS processed_successfully,
            CASE WHEN failed THEN 'Parsing error: ' END AS parsing_error FROM p""",
        "o20_nodeinfo_changes": f"{_HEARD} SELECT * EXCLUDE (step) FROM ({_NODEINFO})",
        "o21_gateway_changes": f"{_HEARD} SELECT * EXCLUDE (step) FROM ({_GATEWAYS})",
        "o22_topic_message_type": f"{_P} SELECT seq, topic, {_KIND} AS message_type FROM p",
        "o23_topic_channel": f"{_P} SELECT seq, topic, {_CHANNEL} AS channel FROM p",
        "o24_hex_to_node_id": f"""{_P} SELECT seq, {_node_id('gateway_id')} AS gateway_node,
            from_node_id AS sender_node, CAST(NULL AS BIGINT) AS not_hex,
            CAST(NULL AS BIGINT) AS too_big FROM p""",
        "o25_enum_name": f"""{_P} SELECT seq, portnum, {_PORT_NAME} AS portnum_name, hw_model,
            {_HW_NAME} AS hw_name FROM (SELECT *, portnum AS port FROM p)""",
        "o26_hw_label": f"""{_P} SELECT seq, replace({_HW_NAME}, 'UNSET', 'Unknown') AS hw_label,
            concat('X_Unknown_', replace(text, 'UNSET', 'Unknown')) AS longer_label FROM p""",
        "o27_mac_text": f"{_P} SELECT seq, {_MAC} AS mac_address FROM p",
        "o28_empty_to_null": f"""{_P} SELECT seq, nullif(long_name, '') AS long_name,
            nullif(short_name, '') AS short_name, nullif(user_id, '') AS user_id FROM p""",
        "o29_payload_columns": f"""{_P} SELECT seq,
            CASE WHEN failed THEN 0 ELSE strlen(text) END AS payload_length,
            CASE WHEN failed THEN '' ELSE hex(text) END AS raw_payload FROM p""",
        "o30_arrival_timestamp": f"""{_P} SELECT seq, epoch_us(ingest_ts) AS from_fraction,
            coalesce(rx_time, seq) * 1000000 AS from_whole FROM p""",
        "o31_labels": f"""{_P} SELECT seq,
            concat('!', lpad(lower(hex(coalesce(from_node_id, seq))), 8, '0')) AS node_label,
            coalesce(nullif(long_name, ''), nullif(short_name, ''), 'No name') AS display_name,
            coalesce(nullif(gateway_id, ''), 'unknown') AS gateway_label FROM p""",
        "o32_first_arrival": f"""{_HEARD} SELECT {_SHOWN} FROM heard
            QUALIFY {_FIRST.format(order='ingest_ts, seq')}""",
        "o33_first_arrival_stream": f"""{_HEARD}
            SELECT mesh_packet_id, gateway_id, seq FROM heard QUALIFY {_FIRST.format(order='seq')}""",
        "o32_keyless_repeats": f"""{_HEARD} SELECT CASE WHEN mesh_packet_id IS NULL THEN 0 ELSE seq END AS seq,
            {_SHOWN.removeprefix('seq, ')} FROM heard QUALIFY {_FIRST.format(order='ingest_ts, seq')}""",
        "o02_mixed_writers": _HISTORY,
        "o03_mixed_writers": _NODES,
        "o10_rejected_nodes": f"""{_HEARD} SELECT ingest_ts AS "timestamp", seq, from_node_id AS node_id, channel_id,
            CASE WHEN bad_user THEN 'node description does not parse'
              WHEN {_HW_NAME} IS NULL THEN 'hw_model has no name' ELSE 'role has no name' END AS reject_reason
            FROM heard WHERE port = 4 AND (bad_user OR {_HW_NAME} IS NULL OR {_ROLE_NAME} IS NULL)""",
        "o33_state_stream": _KEPT,
        "o33_within_watermark": _KEPT,
        "o36_stateful_stream": _NODES,
        "o33_ingest_history": _HISTORY,
        "o34_node_changes": f"""{_CHANGES}
            SELECT * FROM changes""",
        "o35_fold_nodes": _NODES,
        "o35_gateway_edges": f"{_HEARD}, changes AS ({_GATEWAYS}) {_FOLD}",
        "o36_merge_nodes": _NODES,
        "o36_ingest_nodes": _NODES,
        "o37_new_only": _NEW,
        "o37_new_only_thinned": _NEW,
        "packet_history_table": _HISTORY,
        "node_info_table": _NODES,
    }
