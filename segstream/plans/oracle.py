"""DuckDB SQL for every registered query (same column names and values).

The stream view is spelled out in SQL: segment by the md5 rule, offsets as a
plain window sum per segment (the Spark side computes the same numbers with a
two-level prefix sum).
"""

from __future__ import annotations

SEG = "CAST(((('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT * {n}) // 4294967296) AS BIGINT)"


def _stream(name: str, src: str, key: str, payload: str, order: str, ts: str, n: int = 3, tiebreak: bool = False) -> str:
    seg = SEG.format(key=key, n=n)
    order_by = "seq, event" if tiebreak else "seq"
    return f"""{name}0 AS (
  SELECT 'demo' AS scope, CAST({key} AS VARCHAR) AS routing_key, {payload} AS event, CAST({order} AS BIGINT) AS seq,
         {ts} AS append_ts, CAST(8 + strlen({payload}) AS BIGINT) AS len, {seg} AS segment_id
  FROM {src}),
{name} AS (
  SELECT *, CAST(COALESCE(SUM(len) OVER (PARTITION BY segment_id ORDER BY {order_by}
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM {name}0)"""


EV = "WITH " + _stream("ev", "events", "user_id", "props", "event_id", "ts")
MARKS = """marks AS (
  SELECT min(event_id) + (max(event_id) - min(event_id)) // 4 AS t1,
         min(event_id) + (3 * (max(event_id) - min(event_id))) // 4 AS t2,
         min(event_id) + (max(event_id) - min(event_id)) // 2 AS mid,
         min(event_id) + (7 * (max(event_id) - min(event_id))) // 8 AS t3
  FROM events)"""
EVM = EV + ",\n" + MARKS
IDS = "WITH " + _stream("ids", "events", "user_id", "CAST(event_id AS VARCHAR)", "event_id", "ts")

PAYLOAD_ROWS = 'SELECT event AS payload, segment_id, "offset" FROM ev'


_P = "('0x' || substr(md5(routing_key), 1, 8))::BIGINT"
_B1, _B2 = -(-(1 << 32) // 3), -(-2 * (1 << 32) // 3)  # borders of three uniform ranges
_C1, _C2 = _B1 + (_B2 - _B1) // 3, _B1 + 2 * (_B2 - _B1) // 3  # of the second one's thirds
PARTIAL = EVM + f""",
pp AS (SELECT seq, len, {_P} AS p, seq >= (SELECT mid FROM marks) AS split, seq >= (SELECT t3 FROM marks) AS merged FROM ev),
ps AS (SELECT seq, len, CAST(CASE
    WHEN merged AND p < {_C1} THEN 2 * 4294967296 + 6
    WHEN split AND p >= {_B1} AND p < {_C1} THEN 4294967296 + 3
    WHEN split AND p >= {_C1} AND p < {_C2} THEN 4294967296 + 4
    WHEN split AND p >= {_C2} AND p < {_B2} THEN 4294967296 + 5
    ELSE p * 3 // 4294967296 END AS BIGINT) AS segment_id FROM pp),
sc AS (SELECT seq, segment_id, CAST(COALESCE(SUM(len) OVER (PARTITION BY segment_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM ps)"""


def _batch_ids(budget: int) -> str:
    each = max(1, budget // 3)
    return EV.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
hop AS MATERIALIZED (SELECT a.segment_id, a."offset" AS o, b."offset" AS nxt
  FROM ev a ASOF JOIN ev b ON a.segment_id = b.segment_id AND a."offset" + {each} <= b."offset"),
chain AS (
  SELECT segment_id, CAST(0 AS BIGINT) AS batch, min("offset") AS pos FROM ev GROUP BY segment_id
  UNION ALL SELECT chain.segment_id, batch + 1, nxt FROM chain JOIN hop ON hop.segment_id = chain.segment_id AND hop.o = chain.pos)
SELECT ev.segment_id, ev."offset", batch FROM ev ASOF JOIN chain ON ev.segment_id = chain.segment_id AND ev."offset" >= chain.pos"""


def _next_cut(budget: int) -> str:
    return EV + f"""
SELECT segment_id, CAST(max("offset" + len) AS BIGINT) AS position
FROM ev WHERE "offset" < greatest(1, {budget} // 3) GROUP BY segment_id"""


SCALED = EVM + """,
sc0 AS (
  SELECT seq, len, CASE WHEN seq < (SELECT mid FROM marks)
    THEN """ + SEG.format(key="routing_key", n=3) + """
    ELSE 4294967296 + """ + SEG.format(key="routing_key", n=6) + """ END AS segment_id
  FROM ev),
sc AS (
  SELECT seq, segment_id, CAST(COALESCE(SUM(len) OVER (PARTITION BY segment_id ORDER BY seq
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM sc0)"""

TXN = """txn AS (
  SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

ORACLE: dict[str, str] = {
    "route_to_segment": EV + "\nSELECT seq, routing_key, segment_id FROM ev",
    "assign_offsets": EV + '\nSELECT seq, segment_id, "offset", len FROM ev',
    "scan_full": EV + "\nSELECT event AS payload, 'demo' AS scope, 'events' AS stream, segment_id, \"offset\" FROM ev",
    "stream_scan": EV + "\nSELECT event AS payload, 'demo' AS scope, 'events' AS stream, segment_id, \"offset\" FROM ev",
    "scan_columns": EV + '\nSELECT segment_id, "offset" FROM ev',
    "count_events": "SELECT count(*) AS events FROM events",
    "decode_event": EV + '\nSELECT segment_id, "offset", event AS payload FROM ev',
    "scan_defaults": EV + "\n" + PAYLOAD_ROWS,
    "scan_cut_range": EVM + "\n" + PAYLOAD_ROWS + " WHERE seq >= (SELECT t1 FROM marks) AND seq < (SELECT t2 FROM marks)",
    "scan_from_cut": EVM + "\n" + PAYLOAD_ROWS + " WHERE seq >= (SELECT t1 FROM marks)",
    "scan_to_cut": EVM + "\n" + PAYLOAD_ROWS + " WHERE seq < (SELECT t2 FROM marks)",
    "union_self": EV + "\n" + PAYLOAD_ROWS + "\nUNION ALL\n" + PAYLOAD_ROWS,
    "next_cut_b1": _next_cut(1),
    "next_cut_b10": _next_cut(10),
    "next_cut_b20": _next_cut(20),
    "next_cut_b33": _next_cut(33),
    "next_cut_b100": _next_cut(100),
    "next_cut_b1000": _next_cut(1000),
    "next_cut_b100000": _next_cut(100000),
    **{f"batch_ids_b{b}": _batch_ids(b) for b in (1, 10, 20, 33, 100, 1000, 100000)},
    "cut_roundtrip": EV + """,
tail AS (SELECT segment_id, CAST(max("offset" + len) AS BIGINT) AS position FROM ev GROUP BY segment_id),
txt AS (SELECT '{' || string_agg('"' || CAST(segment_id AS VARCHAR) || '":' || CAST(position AS VARCHAR), ',' ORDER BY segment_id) || '}' AS cut_text FROM tail)
SELECT segment_id, position, cut_text FROM tail, txt""",
    "meta_stream_info": EV + """,
tail AS (SELECT segment_id, CAST(max("offset" + len) AS BIGINT) AS position, CAST(min("offset") AS BIGINT) AS head FROM ev GROUP BY segment_id)
SELECT '{' || string_agg('"' || CAST(segment_id AS VARCHAR) || '":' || CAST(head AS VARCHAR), ',' ORDER BY segment_id) || '}' AS head_stream_cut,
       '{' || string_agg('"' || CAST(segment_id AS VARCHAR) || '":' || CAST(position AS VARCHAR), ',' ORDER BY segment_id) || '}' AS tail_stream_cut
FROM tail""",
    "meta_streams": "SELECT DISTINCT 'demo' AS scope_name, event_type AS stream_name FROM events",
    "append_readback": EV + "\n" + PAYLOAD_ROWS,
    "append_alo_readback": EV + "\n" + PAYLOAD_ROWS,
    "write_projection": EV + "\n" + PAYLOAD_ROWS,
    "txn_dedup_replay": EV + "\n" + PAYLOAD_ROWS,
    "stream_append": EV + "\n" + PAYLOAD_ROWS,
    "committed_only": "WITH " + TXN + """,
li0 AS (
  SELECT l_orderkey, l_linenumber, l_orderkey * 8 + l_linenumber AS seq,
         CAST(8 + strlen(CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR)) AS BIGINT) AS len,
         """ + SEG.format(key="l_orderkey", n=3) + """ AS segment_id
  FROM txn WHERE o_orderstatus = 'F')
SELECT l_orderkey, l_linenumber, segment_id,
       CAST(COALESCE(SUM(len) OVER (PARTITION BY segment_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
FROM li0""",
    "abort_leaves_nothing": "WITH " + TXN + """
SELECT o_orderstatus AS status, count(*) AS staged_events,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS visible_events
FROM txn GROUP BY o_orderstatus""",
    "expired_txns": """SELECT o_orderstatus AS status, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN n ELSE 0 END) AS BIGINT) AS visible_events,
CAST(MAX(CASE WHEN o_orderstatus <> 'F' AND n > 0 THEN 1 ELSE 0 END) AS BIGINT) AS removed_txns
FROM (SELECT o_orderstatus, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders) GROUP BY o_orderstatus""",
    "update_as_append": """WITH r AS (SELECT min(event_id) AS lo, max(event_id) - min(event_id) + 1 AS width FROM events),
b AS (SELECT CAST(((event_id - r.lo) * 10) // r.width AS BIGINT) AS batch_id, CAST(user_id AS VARCHAR) AS key FROM events, r),
per AS (SELECT batch_id, key, count(*) AS n FROM b GROUP BY batch_id, key),
c AS (SELECT batch_id, key, CAST(SUM(n) OVER (PARTITION BY key ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS value FROM per)
SELECT batch_id, key, value, '{"key":"' || key || '","value":"' || CAST(value AS VARCHAR) || '"}' AS event FROM c""",
    "truncate_at_cut": EVM + "\n" + PAYLOAD_ROWS + " WHERE seq >= (SELECT t1 FROM marks)",
    "scan_truncated": EVM + "\n" + PAYLOAD_ROWS + " WHERE seq >= (SELECT t1 FROM marks)",
    "stream_truncated_start": EVM + "\n" + PAYLOAD_ROWS + " WHERE seq >= (SELECT t1 FROM marks)",
    "retention_by_time": EV + """
SELECT seq, segment_id, "offset" FROM ev
WHERE append_ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
    "retention_by_size": EV + """,
r AS (SELECT seq, segment_id, "offset", SUM(len) OVER (ORDER BY seq DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS newer FROM ev)
SELECT seq, segment_id, "offset" FROM r WHERE newer <= 100000""",
    "scale_reroute": SCALED + '\nSELECT seq, segment_id, "offset" FROM sc',
    "scan_across_epochs": SCALED + """
SELECT seq, segment_id, "offset" FROM sc WHERE seq >= (SELECT t1 FROM marks) AND seq < (SELECT t3 FROM marks)""",
    "scale_partial": PARTIAL + '\nSELECT seq, segment_id, "offset" FROM sc',
    "scan_across_partial": PARTIAL + """
SELECT seq, segment_id, "offset" FROM sc WHERE seq >= (SELECT t1 FROM marks) AND seq < (SELECT t2 FROM marks)""",
    "segment_load": EV + """
SELECT CAST(floor(epoch(append_ts) / 3600) * 3600 AS BIGINT) AS window_start, segment_id,
       count(*) AS events, CAST(sum(len) AS BIGINT) AS bytes, count(*) > 9 AS needs_split
FROM ev GROUP BY 1, 2""",
    "ordered_by_key": EV + """
SELECT routing_key, CAST(row_number() OVER (PARTITION BY routing_key ORDER BY segment_id, "offset") - 1 AS BIGINT) AS key_seq,
       segment_id, "offset" FROM ev""",
    "decode_int": IDS + "\nSELECT seq, CAST(event AS INTEGER) AS value FROM ids",
    "map_plus_one": IDS + "\nSELECT seq, CAST(event AS INTEGER) + 1 AS value_plus_one FROM ids",
    "self_join_mod5": """WITH side AS (SELECT event_id % 5 AS key, count(*) AS n, sum(event_id) AS s FROM events GROUP BY 1)
SELECT l.key, CAST(l.n * r.n AS BIGINT) AS pairs, CAST(l.s * r.n AS BIGINT) AS sum_left, CAST(r.s * l.n AS BIGINT) AS sum_right
FROM side l JOIN side r ON l.key = r.key""",
    "count_by_key": "SELECT props AS payload, count(*) AS count FROM events GROUP BY props",
    "event_from_row": "WITH " + _stream(
        "rw", "events", "user_id",
        """'{"event_id":' || CAST(event_id AS VARCHAR) || ',"user_id":' || CAST(user_id AS VARCHAR) || ',"event_type":"' || event_type || '"}'""",
        "event_id", "ts") + '\nSELECT seq, event AS payload, segment_id, "offset" FROM rw',
    "event_from_map": "WITH " + _stream(
        "mp", "events", "user_id",
        """'{"key":"' || CAST(user_id AS VARCHAR) || '","value":"' || CAST(event_id AS VARCHAR) || '"}'""",
        "event_id", "ts") + '\nSELECT seq, event AS payload, segment_id, "offset" FROM mp',
    "json_tuple_readback": "SELECT CAST(event_id AS BIGINT) AS seq, CAST(user_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS value FROM events",
    "conversations_offsets": "WITH " + _stream("cv", "conversations", "conv_id", "text", "conv_id * 1000000 + turn", "NULL", 4)
    + '\nSELECT seq, segment_id, "offset", len FROM cv',
}

DOCS = "WITH " + _stream("dc", "documents", "source", "text", "doc_id", "NULL", 4)
ORACLE["documents_offsets"] = DOCS + '\nSELECT seq, segment_id, "offset", len FROM dc'
ORACLE["documents_next_cut"] = DOCS + """,
segs AS (SELECT CAST(segment_id AS BIGINT) AS segment_id FROM (VALUES (0), (1), (2), (3)) t(segment_id))
SELECT s.segment_id, CAST(COALESCE(max(d."offset" + d.len), 0) AS BIGINT) AS position
FROM segs s LEFT JOIN dc d ON d.segment_id = s.segment_id AND d."offset" < 400000 // 4
GROUP BY s.segment_id"""

LI_JSON = ("""'{"l_orderkey":' || CAST(l_orderkey AS VARCHAR) || ',"l_linenumber":' || CAST(l_linenumber AS VARCHAR)"""
           """ || ',"l_partkey":' || CAST(l_partkey AS VARCHAR) || ',"l_suppkey":' || CAST(l_suppkey AS VARCHAR)"""
           """ || ',"l_returnflag":"' || l_returnflag || '","l_linestatus":"' || l_linestatus || '"}'""")
ORACLE["lineitem_offsets"] = ("WITH " + _stream("li", "lineitem", "l_orderkey", LI_JSON, "l_orderkey * 8 + l_linenumber",
                                               "l_shipdate", 16, tiebreak=True) + '\nSELECT seq, segment_id, "offset", len FROM li')

ORACLE["pages_offsets"] = ("WITH " + _stream("pg", "pages", "page_id", "html", "page_id", "NULL", 4)
                           + '\nSELECT seq, segment_id, "offset", len FROM pg')

# Same numbers as the Spark frame version of StreamInfo.
ORACLE["meta_stream_info_frame"] = ORACLE["meta_stream_info"]
