"""Feature-table queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tracewarden.catalog.log_queries import _any, entries
from tracewarden.catalog.registry import query
from tracewarden.catalog.views import table, view
from tracewarden.config import DEFAULTS
from tracewarden.functions import patterns as P
from tracewarden.operators import byte_features as B
from tracewarden.operators import flow_features as L
from tracewarden.operators import serverlog_features as S

_ENTRIES = ["entries"]
#: A site that the fixture's referrers do not belong to, and a gap that its flows do reach.
_CFG = replace(DEFAULTS, site_host="www.example.org", idle_gap_s=1.0)


def _flag(test: str, name: str) -> str:
    return f"CAST(CASE WHEN {test} THEN 1 ELSE 0 END AS INT) AS {name}"


def _has(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, '{pattern}', 'i')"


def _serverlog(name: str, sql: str, columns):
    @query(name, f"SELECT seq, {sql} FROM entries", _ENTRIES)
    def _(spark, sf_dir):
        return entries(spark, sf_dir).select("seq", *[c.alias(n) for n, c in columns().items()])


_TIME = ", ".join([
    "CAST(hour(dt) AS INT) AS hour", "CAST(isodow(dt) - 1 AS INT) AS day_of_week", "CAST(month(dt) AS INT) AS month",
    _flag("isodow(dt) >= 6", "is_weekend"), _flag("hour(dt) BETWEEN 6 AND 21", "is_business_hours"),
])
_REQUEST = ", ".join([
    "CAST(list_position(['DELETE','GET','HEAD','OPTIONS','PATCH','POST','PUT'], upper(method)) - 1 AS INT) AS method_encoded",
    "CAST(length(endpoint) AS INT) AS endpoint_length",
    "CAST(CASE WHEN trim(endpoint, '/') = '' THEN 0 ELSE len(string_split(trim(endpoint, '/'), '/')) END AS INT) AS endpoint_depth",
    _flag("contains(endpoint, '?')", "has_query_params"),
    "CAST(CASE WHEN contains(endpoint, '?') AND split_part(endpoint, '?', 2) <> '' THEN length(regexp_replace(endpoint[strpos(endpoint, '?') + 1:], '[^&]', '', 'g')) + 1 ELSE 0 END AS INT) AS query_param_count",
    "CAST(length(regexp_replace(endpoint, '[A-Za-z0-9/]', '', 'g')) AS INT) AS special_char_count",
    _flag("contains(lower(endpoint), 'admin')", "is_admin_endpoint"),
    "status", "bytes_sent AS bytes", "response_time",
    *[_flag(f"status // 100 = {i}", f"status_{i}xx") for i in range(1, 6)],
    _flag("status >= 400", "is_error"),
])
_EDGE, _OPERA = _has("user_agent", "Edge/|Edg/"), _has("user_agent", "OPR/|Opera")
_IOS, _ANDROID = _has("user_agent", "iPhone|iPad|iPod"), _has("user_agent", "Android")
_AGENT = ", ".join([
    "CAST(length(user_agent) AS INT) AS ua_length",
    _flag(f"{_has('user_agent', 'Chrome/')} AND NOT {_EDGE} AND NOT {_OPERA}", "is_chrome"),
    _flag(_has("user_agent", "Firefox/"), "is_firefox"),
    _flag(f"{_has('user_agent', 'Safari/')} AND NOT {_has('user_agent', 'Chrome/')} AND NOT {_EDGE} AND NOT {_OPERA}", "is_safari"),
    _flag(_EDGE, "is_edge"), _flag(_OPERA, "is_opera"),
    _flag(_has("user_agent", "Windows"), "is_windows"),
    _flag(f"{_has('user_agent', 'Macintosh|Mac OS X')} AND NOT {_IOS}", "is_mac"),
    _flag(f"{_has('user_agent', 'Linux')} AND NOT {_ANDROID}", "is_linux"),
    _flag(_ANDROID, "is_android"), _flag(_IOS, "is_ios"),
    _flag(f"{_ANDROID} OR {_IOS} OR {_has('user_agent', 'Mobile')}", "is_mobile"),
    _flag(f"{_has('user_agent', 'bot|crawler|spider|wget/')} OR {_any('user_agent', P.ATTACK_TOOLS)}", "is_bot"),
    _flag("referrer NOT IN ('', '-')", "has_referrer"),
    "CAST(CASE WHEN referrer NOT IN ('', '-') THEN length(referrer) ELSE 0 END AS INT) AS referrer_length",
    _flag("referrer NOT IN ('', '-') AND lower(regexp_extract(referrer, '^[A-Za-z]+://([^/:?#]+)', 1)) <> 'www.example.org'", "is_external_referrer"),
])
_ADDRESS = ", ".join([
    *[f"TRY_CAST(split_part(ip, '.', {i}) AS INT) AS ip_octet_{i}" for i in range(1, 5)],
    _flag("starts_with(ip, '10.') OR starts_with(ip, '192.168.')", "is_private_ip"),
    _flag(_any("endpoint", P.SQL_INJECTION), "is_sql_injection"),
    _flag(_any("endpoint", P.XSS), "is_xss"),
    _flag(_any("endpoint", P.PATH_TRAVERSAL), "is_path_traversal"),
    _flag(_any("endpoint", P.COMMAND_INJECTION), "is_command_injection"),
])

_serverlog("serverlog_time_features", _TIME, lambda: S.time_columns(_CFG))
_serverlog("serverlog_request_features", _REQUEST, S.request_columns)
_serverlog("serverlog_agent_features", _AGENT, lambda: S.agent_columns(_CFG))
_serverlog("serverlog_ip_attack_features", _ADDRESS, lambda: {**S.address_columns(), **S.attack_columns()})


@query("serverlog_features", f"SELECT seq, {_TIME}, {_REQUEST}, {_AGENT}, {_ADDRESS} FROM entries", _ENTRIES)
def _(spark, sf_dir):
    return S.serverlog_features(entries(spark, sf_dir), cfg=_CFG)


# -- flows ------------------------------------------------------------------------------------
# The packets of the fixture, a third of them as answers.

_KEY = "host_a, host_b, dst_port, protocol"
_FLOWS = f"""
, keyed AS (SELECT *, least(src_ip, dst_ip) AS host_a, greatest(src_ip, dst_ip) AS host_b FROM two_way)
, flows AS (
  SELECT *, src_ip = first_value(src_ip) OVER (PARTITION BY {_KEY} ORDER BY packet_no) AS fwd,
    (ts - lag(ts) OVER (PARTITION BY {_KEY} ORDER BY packet_no)) * 1000000 AS gap,
    (ts - lag(ts) OVER (PARTITION BY {_KEY}, src_ip ORDER BY packet_no)) * 1000000 AS side_gap
  FROM keyed)"""
_WAYS = {"Fwd": "FILTER (fwd)", "Bwd": "FILTER (NOT fwd)"}


def two_way(spark, sf_dir):
    return view(spark, sf_dir, "two_way")


def _rounded(df):
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), 4).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def _spread(value: str, name: str, way: str = "") -> str:
    return ", ".join([
        f'round(avg({value}) {way}, 4) AS "{name} Mean"', f'round(stddev_samp({value}) {way}, 4) AS "{name} Std"',
        f'round(max({value}) {way}, 4) AS "{name} Max"', f'round(min({value}) {way}, 4) AS "{name} Min"',
    ])


def _nulls(names, kind="DOUBLE") -> str:
    return ", ".join(f'CAST(NULL AS {kind}) AS "{n}"' for n in names)


_S = "nullif((max(ts) - min(ts)), 0)"
_SUB = "CAST(count(*) FILTER (gap > 1000000) + 1 AS DOUBLE)"
_N = {d: f"count(*) {way}" for d, way in _WAYS.items()}
_TOTAL = {d: f"CAST(coalesce(sum(size) {way}, 0) AS BIGINT)" for d, way in _WAYS.items()}
_SIZE = "CAST(size AS DOUBLE)"

_VOLUME = f"""SELECT {_KEY}, dst_port AS "Destination Port", (max(ts) - min(ts)) * 1000000 AS "Flow Duration",
  {_N['Fwd']} AS "Total Fwd Packets", {_N['Bwd']} AS "Total Backward Packets",
  {_TOTAL['Fwd']} AS "Total Length of Fwd Packets", {_TOTAL['Bwd']} AS "Total Length of Bwd Packets",
  {', '.join(_spread(_SIZE, f'{d} Packet Length', way) for d, way in _WAYS.items())},
  round(sum(size) / {_S}, 4) AS "Flow Bytes/s", round(count(*) / {_S}, 4) AS "Flow Packets/s",
  {', '.join(f'round({n} / {_S}, 4) AS "{d} Packets/s"' for d, n in _N.items())},
  CAST(min(size) AS DOUBLE) AS "Min Packet Length", CAST(max(size) AS DOUBLE) AS "Max Packet Length",
  round(avg(size), 4) AS "Packet Length Mean", round(stddev_samp({_SIZE}), 4) AS "Packet Length Std",
  round(stddev_samp({_SIZE}) * stddev_samp({_SIZE}), 4) AS "Packet Length Variance",
  round({_N['Bwd']} / CAST({_N['Fwd']} AS DOUBLE), 4) AS "Down/Up Ratio", round(sum(size) / CAST(count(*) AS DOUBLE), 4) AS "Average Packet Size",
  {', '.join(f'round(avg(size) {way}, 4) AS "Avg {d} Segment Size"' for d, way in _WAYS.items())},
  {', '.join(f'round({n} / {_SUB}, 4) AS "Subflow {d} Packets"' for d, n in _N.items())},
  {', '.join(f'round({n} / {_SUB}, 4) AS "Subflow {d} Bytes"' for d, n in _TOTAL.items())}
FROM flows GROUP BY {_KEY}"""


@query("flow_volume_features", _FLOWS + "\n" + _VOLUME, ["two_way"])
def _(spark, sf_dir):
    return _rounded(L.flow_volume_features(two_way(spark, sf_dir)))


_IAT = f"""SELECT {_KEY}, {_spread('gap', 'Flow IAT')},
  {', '.join(f'round(sum(side_gap) {way}, 4) AS "{d} IAT Total", ' + _spread('side_gap', f'{d} IAT', way) for d, way in _WAYS.items())}
FROM flows GROUP BY {_KEY}"""


@query("flow_iat_features", _FLOWS + "\n" + _IAT, ["two_way"])
def _(spark, sf_dir):
    return _rounded(L.flow_iat_features(two_way(spark, sf_dir)))


_BURSTS = f"""
, numbered AS (SELECT *, sum(CASE WHEN gap > 1000000 THEN 1 ELSE 0 END) OVER (PARTITION BY {_KEY} ORDER BY packet_no) AS burst FROM flows)
, bursts AS (SELECT {_KEY}, burst, (max(ts) - min(ts)) * 1000000 AS active,
  max(CASE WHEN gap > 1000000 THEN gap END) AS idle FROM numbered GROUP BY {_KEY}, burst)"""
_ACTIVE = f"""SELECT {_KEY}, {_spread('active', 'Active')}, {_spread('idle', 'Idle')} FROM bursts GROUP BY {_KEY}"""


@query("flow_active_idle", _FLOWS + _BURSTS + "\n" + _ACTIVE, ["two_way"])
def _(spark, sf_dir):
    return _rounded(L.flow_active_idle(two_way(spark, sf_dir), cfg=_CFG))


def _flag_count(bit: int, way: str = "") -> str:
    return f"CAST(sum(CASE WHEN tcp_flags & {bit} > 0 THEN 1 ELSE 0 END) {way} AS BIGINT)"


_FWD, _BWD = _WAYS.values()
_HEADERS = f"""{_flag_count(8, _FWD)} AS "Fwd PSH Flags", {_flag_count(32, _FWD)} AS "Fwd URG Flags",
  CAST(sum(header_len) {_FWD} AS BIGINT) AS "Fwd Header Length", CAST(sum(header_len) {_BWD} AS BIGINT) AS "Bwd Header Length",
  {', '.join(f'{_flag_count(bit)} AS "{flag} Flag Count"' for flag, bit in L.FLAG_BITS.items())},
  CAST(sum(header_len) {_FWD} AS BIGINT) AS "Fwd Header Length.1",
  first(win ORDER BY packet_no) {_FWD} AS "Init_Win_bytes_forward", first(win ORDER BY packet_no) {_BWD} AS "Init_Win_bytes_backward",
  CAST(sum(CASE WHEN size > header_len THEN 1 ELSE 0 END) {_FWD} AS BIGINT) AS "act_data_pkt_fwd",
  min(header_len) {_FWD} AS min_seg_size_forward"""
#: The packet record has no TCP fields; these are derived from the size.
_TCP = ", tcp AS (SELECT *, size % 256 AS tcp_flags, 20 + 4 * (size % 3) AS header_len, size * 7 AS win FROM flows)"


def _with_tcp(df):
    return df.withColumns({"tcp_flags": F.col("size") % 256, "header_len": F.lit(20) + 4 * (F.col("size") % 3), "win": F.col("size") * 7})


@query("flow_header_features", _FLOWS + _TCP + f"\nSELECT {_KEY}, {_HEADERS} FROM tcp GROUP BY {_KEY}", ["two_way"])
def _(spark, sf_dir):
    return L.flow_header_features(_with_tcp(two_way(spark, sf_dir)))


_HEADER = [
    "Fwd PSH Flags", "Fwd URG Flags", "Fwd Header Length", "Bwd Header Length",
    *[f"{flag} Flag Count" for flag in L.FLAG_BITS], "Fwd Header Length.1",
    "Init_Win_bytes_forward", "Init_Win_bytes_backward", "act_data_pkt_fwd", "min_seg_size_forward",
]


@query("flow_features", _FLOWS + _BURSTS + f"""
, v AS ({_VOLUME}), i AS ({_IAT}), a AS ({_ACTIVE})
SELECT *, {_nulls(_HEADER, 'BIGINT')} FROM v JOIN i USING ({_KEY}) JOIN a USING ({_KEY})""", ["two_way"])
def _(spark, sf_dir):
    """All flow columns; the packet record has no TCP fields, so those are NULL."""
    return _rounded(L.flow_features(two_way(spark, sf_dir), cfg=_CFG))


@query("flow_features_tcp", _FLOWS + _BURSTS + _TCP + f"""
, v AS ({_VOLUME}), i AS ({_IAT}), a AS ({_ACTIVE}), h AS (SELECT {_KEY}, {_HEADERS} FROM tcp GROUP BY {_KEY})
SELECT * FROM v JOIN i USING ({_KEY}) JOIN a USING ({_KEY}) JOIN h USING ({_KEY})""", ["two_way"])
def _(spark, sf_dir):
    """All flow columns with none of them NULL."""
    return _rounded(L.flow_features(_with_tcp(two_way(spark, sf_dir)), cfg=_CFG))


# -- bytes ------------------------------------------------------------------------------------

_BYTES = """WITH octets AS (
  SELECT doc_id, n, i - 1 AS pos, CAST('0x' || pair AS INT) AS byte FROM (
    SELECT doc_id, len(pairs) AS n, unnest(pairs) AS pair, unnest(range(1, len(pairs) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(hex(encode(text)), '..') AS pairs FROM documents)))"""


@query("byte_histogram", _BYTES + """
SELECT doc_id, byte, count(*) AS n, round(count(*) / CAST(any_value(n) AS DOUBLE), 8) AS share
FROM octets GROUP BY doc_id, byte""")
def _(spark, sf_dir):
    h = B.byte_histogram(table(spark, sf_dir, "documents"), "doc_id")
    slots = h.select("doc_id", F.posexplode(F.arrays_zip("counts", "histogram")).alias("byte", "v"))
    return slots.select("doc_id", "byte", F.col("v.counts").alias("n"),
                        F.round("v.histogram", 8).alias("share")).filter(F.col("n") > 0)


@query("byte_entropy_histogram", _BYTES + """
, placed AS (
  SELECT doc_id, byte // 16 AS nibble, unnest(CASE WHEN n < 2048 THEN [0] ELSE [pos // 1024, pos // 1024 - 1] END) AS w, n FROM octets)
, counts AS (
  SELECT doc_id, w, nibble, count(*) AS c FROM placed
  WHERE n < 2048 OR (w >= 0 AND w * 1024 + 2048 <= n) GROUP BY 1, 2, 3)
, bins AS (
  SELECT doc_id, w, least(CAST(floor(-sum(c / 2048.0::DOUBLE * log2(c / 2048.0::DOUBLE)) * 4) AS INT), 15) AS bin FROM counts GROUP BY 1, 2)
SELECT doc_id, CAST(bin * 16 + nibble AS INT) AS slot, CAST(sum(c) AS BIGINT) AS n
FROM counts JOIN bins USING (doc_id, w) GROUP BY 1, 2""")
def _(spark, sf_dir):
    h = B.byte_entropy_histogram(table(spark, sf_dir, "documents"), "doc_id")
    return h.select("doc_id", F.posexplode("counts").alias("slot", "n")).filter(F.col("n") > 0)


@query("string_features", r"""
WITH runs AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20-\x7f]{5,}') AS r FROM documents)
, joined AS (SELECT doc_id, text, len(r) AS numstrings, array_to_string(r, '') AS a FROM runs)
, entropy AS (
  SELECT doc_id, -sum(c / CAST(t AS DOUBLE) * log2(c / CAST(t AS DOUBLE))) AS bits FROM (
    SELECT doc_id, ch, count(*) AS c, sum(count(*)) OVER (PARTITION BY doc_id) AS t FROM (
      SELECT doc_id, unnest(string_split(a, '')) AS ch FROM joined WHERE a <> '') GROUP BY 1, 2) GROUP BY 1)
SELECT doc_id, CAST(numstrings AS INT) AS numstrings,
  round(CASE WHEN numstrings > 0 THEN length(a) / CAST(numstrings AS DOUBLE) ELSE 0 END, 6) AS avlength,
  CAST(length(a) AS INT) AS printables, round(coalesce(bits, 0), 6) AS entropy,
  CAST(len(regexp_extract_all(text, '(?i)c:\\')) AS INT) AS paths,
  CAST(len(regexp_extract_all(text, '(?i)https?://')) AS INT) AS urls,
  CAST(len(regexp_extract_all(text, 'HKEY_')) AS INT) AS registry,
  CAST(len(regexp_extract_all(text, 'MZ')) AS INT) AS "MZ"
FROM joined LEFT JOIN entropy USING (doc_id)""")
def _(spark, sf_dir):
    s = B.string_features(table(spark, sf_dir, "documents"), "doc_id")
    return s.withColumns({"avlength": F.round("avlength", 6), "entropy": F.round("entropy", 6)})
