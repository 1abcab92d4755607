"""The queries as SQL for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

from adtally.functions.labels import TV_CHANNELS
from adtally.plans.adapters import PACK_WORDS
from adtally.plans.queries import ACTIVE_AD, BOUNDARY, LIMITED_FILES, PARTS, RANGES, REACH_WORDS, START_DAY, START_LINE

TRACKING = """tracking AS (
 SELECT event_id, ts, strftime(ts, '%Y%m%d') AS d, CAST(hour(ts) AS INT) AS h,
  CAST(user_id % 10 AS VARCHAR) AS client_id, CAST(user_id % 7 AS INT) AS group_id,
  CAST(user_id % 50 AS INT) AS ad_id, CAST(user_id % 13 AS INT) AS creative_id,
  CAST(user_id % 20 AS VARCHAR) AS tag_id, CAST(k % 8 AS VARCHAR) AS channel_id,
  CAST(user_id % 31 AS VARCHAR) AS city, CAST(k % 3 AS VARCHAR) AS placement_id,
  CASE k % 6 WHEN 0 THEN 'youku' WHEN 1 THEN 'iqiyi' WHEN 2 THEN 'letv' WHEN 3 THEN 'tencent'
   WHEN 4 THEN 'baidu_bc' ELSE 'bc' END AS source,
  CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 6
   ELSE CASE k % 3 WHEN 0 THEN 4 WHEN 1 THEN 5 ELSE 7 END END AS event,
  CAST(value AS DECIMAL(18,4)) AS price
 FROM (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events))"""

BIDS = """bids AS (
 SELECT concat(CASE WHEN user_id % 5 = 0 THEN 'imei' ELSE 'idfa-' END, CAST(user_id AS VARCHAR)) AS user_id,
  concat('10.0.0.', CAST(k % 20 AS VARCHAR)) AS ip, CAST(floor(epoch(ts)) AS BIGINT) AS time_i,
  strftime(ts, '%Y%m%d') AS d, CAST(hour(ts) AS INT) AS h,
  CASE WHEN event_id % 4 < 3 THEN 640 ELSE 1280 END AS width,
  CASE WHEN event_id % 4 < 3 THEN 480 ELSE 720 END AS height,
  CAST(user_id % 3 AS INT) AS device_type,
  CASE k % 7 WHEN 0 THEN 'Windows NT' WHEN 1 THEN 'Mac OS X' WHEN 2 THEN 'Linux x86' WHEN 3 THEN 'iOS 9'
   WHEN 4 THEN 'Android 6' WHEN 5 THEN 'Symbian' END AS os,
  CASE WHEN k % 8 = 7 THEN '' ELSE concat('c', CAST(k % 8 AS VARCHAR)) END AS channel,
  CAST(k % 90 AS VARCHAR) AS tagid, concat('p', CAST(k % 90 AS VARCHAR)) AS placementid,
  CASE user_id % 3 WHEN 0 THEN 'app客户端' WHEN 1 THEN 'web' END AS site_or_app_name,
  [event_type, concat('k', CAST(k % 10 AS VARCHAR)), concat('u', CAST(user_id % 6 AS VARCHAR))] AS keywords
 FROM (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events))"""

DELIVERIES = """deliveries AS (
 SELECT l_orderkey AS click_uuid, strftime(l_shipdate, '%Y%m%d') AS d, CAST(l_orderkey % 24 AS INT) AS h,
  CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END AS request_time,
  CAST(l_suppkey % 20 AS VARCHAR) AS ad_id, l_linestatus AS source, 1 AS impression,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS click, CAST(l_quantity AS INT) AS bidprice,
  CAST(l_extendedprice AS DECIMAL(18,4)) AS price, l_returnflag AS subchannel, p_brand AS creative_id,
  [p_type, p_brand, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] AS keywords,
  CASE l_returnflag WHEN 'R' THEN 'IOS' WHEN 'A' THEN 'Android' ELSE '-' END AS system
 FROM lineitem JOIN part ON l_partkey = p_partkey)"""

AD_PACK = """ad_pack AS (
 SELECT CAST((length(keyword) * 7 + ascii(right(keyword, 1)) + shift) % 20 AS VARCHAR) AS ad_id, keyword
 FROM (SELECT DISTINCT unnest([p_type, p_brand, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)])
        AS keyword FROM part), (SELECT unnest([0, 3, 7, 11]) AS shift))"""

PACK = "pack AS (SELECT unnest([{}]) AS keyword)".format(", ".join(f"'{w}'" for w in PACK_WORDS))
PACK_LIST = "[" + ", ".join(f"'{w}'" for w in PACK_WORDS) + "]"

BATCH_BILLED = "event = CASE WHEN source IN ('baidu_bc', 'tencent') THEN 1 ELSE 3 END"
STREAM_BILLED = "(source IN ('bc', 'tencent') AND event = 1) OR event = 3"
PLATFORM = "CASE source WHEN 'bc' THEN 'baidu_bc' ELSE source END"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _counts(keys: str, billed: str = BATCH_BILLED, where: str = "TRUE") -> str:
    names = [key.strip() for key in keys.split(",")]
    shown = ", ".join(names)
    return f"""SELECT {shown}, {PLATFORM} AS platform, d, h,
  count(*) FILTER (event = 1) AS impression, count(*) FILTER (event = 2) AS click,
  count(*) FILTER (event = 4) AS download, count(*) FILTER (event = 5) AS follow,
  count(*) FILTER (event = 6) AS install, count(*) FILTER (event = 7) AS active,
  sum(CASE WHEN {billed} THEN price ELSE 0 END) AS billed
 FROM tracking WHERE {where} GROUP BY {shown}, {PLATFORM}, d, h"""


def _finished(counts: str, positive: bool = True) -> str:
    test = "impression > 0 AND billed > 0" if positive else "TRUE"
    return f"""SELECT * EXCLUDE (billed), CAST(billed AS DOUBLE) / 1000 AS cost
 FROM ({counts}) WHERE {test}"""


ALL_KEYS = "client_id, group_id, ad_id, creative_id, tag_id, channel_id, placement_id"
REPORT_KEYS = {
    "all_report": ALL_KEYS,
    "report": "client_id, group_id, ad_id, creative_id, tag_id, placement_id",
    "channel_report": "client_id, group_id, ad_id, channel_id",
    "geo_report": "client_id, group_id, ad_id, city",
}

OS = """CASE WHEN lower(os) LIKE '%windows%' THEN 'Windows' WHEN lower(os) LIKE '%mac%' THEN 'Mac'
  WHEN lower(os) LIKE '%linux%' THEN 'Linux' WHEN lower(os) LIKE '%ios%' THEN 'IOS'
  WHEN lower(os) LIKE '%android%' THEN 'Android' ELSE 'Other' END"""
ON_DEMAND_DEVICE = "CASE device_type WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Tablet' ELSE 'PC' END"
DAY = "concat(d[1:4], '-', d[5:6], '-', d[7:8])"
SIZE = "concat(width, 'x', height)"

REACH = f"""reach AS (
 SELECT CASE channel WHEN 'c3' THEN '{TV_CHANNELS[0]}' ELSE channel END AS channel, h AS hour, {SIZE} AS size,
  CASE WHEN site_or_app_name IS NULL OR site_or_app_name = '' THEN 'other'
   WHEN site_or_app_name LIKE '%客户端%' THEN 'Mobile' ELSE 'PC' END AS device,
  CASE WHEN lower(os) LIKE '%windows%' THEN 'Windows' WHEN lower(os) LIKE '%linux%' THEN 'Linux'
   WHEN lower(os) LIKE '%mac%' THEN 'Mac' WHEN lower(os) LIKE '%iphone%' OR lower(os) LIKE '%ipad%' OR lower(os) LIKE '%ios%' THEN 'IOS'
   WHEN lower(os) LIKE '%android%' THEN 'Android' ELSE 'Other' END AS system,
  CASE WHEN CAST(tagid AS INT) IN (25,26,27,28,29,30,55,79,82,58,87) THEN CASE channel WHEN 'c3' THEN 'atv' ELSE 'augc' END
   WHEN CAST(tagid AS INT) IN (31,32,34,35,37,38,54,78,81,57,86) THEN CASE channel WHEN 'c3' THEN 'ktv' ELSE 'kugc' END
   WHEN CAST(tagid AS INT) IN (33,19,36,20,39,21,56,80,83,59,88) THEN CASE channel WHEN 'c3' THEN 'ztv' ELSE 'zugc' END ELSE tagid END AS placementid
 FROM bids WHERE list_has_any(keywords, [{", ".join(f"'{w}'" for w in REACH_WORDS)}]) AND channel <> '')"""


def _half_up(a: str, b: str) -> str:
    return f"CAST((200 * CAST({a} AS BIGINT) + {b}) // (2 * {b}) AS DOUBLE) / 100.0"


USED = f"""used AS (
 SELECT user_id AS idfa, ip, strftime(make_timestamp(time_i * 1000000), '%Y%m%d') AS day,
  CAST((time_i % 86400) // 3600 AS INT) AS hr
 FROM bids WHERE width = 640 AND height = 480 AND d BETWEEN '20240102' AND '20240129'
  AND user_id LIKE '%-%')"""

DEVICES = f"""devices AS (
 SELECT idfa, ipcount, vcount, ipmax, vcountmax, vdays, {_half_up('vcount', 'vdays')} AS vdaymean,
  {_half_up('vcount', 'ipcount')} AS vipmean, hours, {_half_up('ipcount', 'vdays')} AS ipdaymean
 FROM (SELECT idfa, count(DISTINCT ip) AS ipcount, count(*) AS vcount, count(DISTINCT hr) AS hours,
        count(DISTINCT day) AS vdays FROM used GROUP BY idfa)
 JOIN (SELECT idfa, max(ips) AS ipmax, max(n) AS vcountmax
        FROM (SELECT idfa, day, count(DISTINCT ip) AS ips, count(*) AS n FROM used GROUP BY idfa, day)
        GROUP BY idfa) USING (idfa))"""

IPS = f"""ips AS (
 SELECT ip, idfacount, vcount, vcountmax, vdays, {_half_up('vcount', 'vdays')} AS vdaymean,
  CAST(hour_mask AS INT) AS hour_mask
 FROM (SELECT ip, count(DISTINCT idfa) AS idfacount, count(*) AS vcount, count(DISTINCT day) AS vdays
        FROM used GROUP BY ip)
 JOIN (SELECT ip, max(n) AS vcountmax FROM (SELECT ip, day, count(*) AS n FROM used GROUP BY ip, day)
        GROUP BY ip) USING (ip)
 JOIN (SELECT ip, sum(pow(2, hr)) AS hour_mask FROM (SELECT DISTINCT ip, hr FROM used) GROUP BY ip)
        USING (ip))"""


def _ranges() -> list[str]:
    parts = []
    for start, end in RANGES:
        parts.append(USED.replace("used AS", f"used{start} AS").replace("'20240102' AND '20240129'", f"'{start}' AND '{end}'"))
        parts.append(DEVICES.replace("devices AS", f"devices{start} AS").replace("FROM used", f"FROM used{start}"))
    return parts


DEVICE_FEATURES = ["ipcount", "vcount", "ipmax", "vcountmax", "vdays", "vdaymean", "vipmean", "hours", "ipdaymean"]
IP_FEATURES = ["idfacount", "vcount", "vcountmax", "vdays", "vdaymean", "hour_mask"]


def _scored(view: str, table: str, name: str, features: list[str], chosen: list[str]) -> str:
    logs = ", ".join(
        f"-pow({f} - m_{f}, 2) / (2 * nullif(v_{f}, 0)) - ln(2 * pi() * nullif(v_{f}, 0)) / 2 AS ln_{f}"
        for f in features
    )
    stats = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in features)
    joint = " + ".join(f"coalesce(ln_{f}, 0)" for f in features)
    probability = " + ".join(f"coalesce(ln_{f}, 0)" for f in chosen)
    return f"""{view} AS (
 SELECT *, {joint} AS ln_joint, exp({probability}) AS p
 FROM (SELECT {name} AS name, {logs} FROM {table}, (SELECT {stats} FROM {table})))"""


DEVICE_SCORED = _scored("device_scored", "devices", "idfa", DEVICE_FEATURES, ["ipcount"])
IP_SCORED = _scored("ip_scored", "ips", "ip", IP_FEATURES, IP_FEATURES)


def _score_rows(view: str, features: list[str]) -> str:
    names = ", ".join(f"round(ln_{f}, 6) AS ln_{f}" for f in [*features, "joint"])
    return f"SELECT name, {names} FROM {view}"


def _bins(view: str) -> str:
    return f"""SELECT bin, round(ln(edge), 6) AS ln_edge, n FROM (
 SELECT bin, max(edge) AS edge, count(*) AS n FROM (
  SELECT p, min(i) AS bin, min(e) AS edge FROM (
   SELECT r, p, i, CASE WHEN i = {PARTS} THEN top ELSE i * top / {PARTS} END AS e
   FROM (SELECT row_number() OVER () AS r, p FROM {view}), (SELECT max(p) AS top FROM {view}),
    (SELECT CAST(unnest(range(1, {PARTS + 1})) AS INT) AS i)) WHERE p <= e GROUP BY r, p) GROUP BY bin)"""


def _halves(select: str) -> str:
    old = _counts(ALL_KEYS, where=f"d <= '{BOUNDARY}'")
    new = _counts(ALL_KEYS, where=f"d >= '{BOUNDARY}'")
    return _with(TRACKING, f"old AS ({old})", f"new AS ({new})") + select


ALL_SLICE = ALL_KEYS + ", platform, d, h"
COUNTERS = ["impression", "click", "download", "follow", "install", "active", "billed"]
SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in COUNTERS[:-1]) + ", sum(billed) AS billed"

INDEX = """feature_ids AS (
 SELECT feature, CAST(row_number() OVER (ORDER BY position, feature) AS BIGINT) AS idx FROM (
  SELECT DISTINCT 0 AS position, concat('sc_', subchannel) AS feature FROM deliveries WHERE subchannel IS NOT NULL
  UNION ALL
  SELECT DISTINCT 1, concat('cr_', creative_id) FROM deliveries WHERE creative_id IS NOT NULL))"""

LABELLED = """labelled AS (
 SELECT click_uuid, subchannel, creative_id, price, CASE WHEN o_orderkey IS NULL THEN 0 ELSE 1 END AS label
 FROM deliveries LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
  ON click_uuid = o_orderkey)"""


def _first_match(words: str) -> str:
    """Report over ``matched`` rows that carry a keyword."""
    return f"""SELECT d, h, coalesce({words}, 'unknown') AS keyword, ad_id, source AS platform,
  CAST(sum(impression) AS BIGINT) AS impression, CAST(sum(click) AS BIGINT) AS click,
  CAST(floor(sum(price)) AS BIGINT) AS cost, CAST(sum(bidprice) AS BIGINT) AS bid
 FROM valid GROUP BY ALL"""


VALID = "valid AS (SELECT * FROM deliveries WHERE request_time <> 0)"
FIRST_IN_PACK = f"list_filter(keywords, lambda w: list_contains({PACK_LIST}, w))[1]"


def _scoped(words: str, on: str) -> str:
    grouped = f"scoped AS ({words})"
    found = f"""found AS (
 SELECT v.*, list_filter(v.keywords, lambda w: list_contains(s.words, w))[1] AS word
 FROM (SELECT * FROM deliveries WHERE request_time <> 0) v LEFT JOIN scoped s ON {on})"""
    return _with(DELIVERIES, AD_PACK, grouped, found) + _first_match("word").replace("FROM valid", "FROM found")


KEYWORD_ROWS = "words AS (SELECT system, subchannel AS channel, unnest(keywords) AS keyword FROM deliveries)"

PAIRS = f"""pairs AS (
 SELECT a, b, count(*) AS n FROM (
  SELECT keywords[i] AS a, keywords[j] AS b
  FROM deliveries, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3, 4]) AS j) WHERE i < j)
 WHERE a <> b AND a IN (FROM pack) AND b IN (FROM pack) GROUP BY a, b)"""

STREAM_COUNTS = _counts(ALL_KEYS, STREAM_BILLED)

ORACLE: dict[str, str] = {
    "tracking_normalize": _with(TRACKING) + """
SELECT client_id, group_id, ad_id, creative_id, concat('from', client_id) AS refer,
  CAST(NULL AS INT) AS time, event, '-' AS url, CAST(price AS DOUBLE) AS price, source,
  CAST(NULL AS VARCHAR) AS user_id, city, tag_id, channel_id, CAST(NULL AS VARCHAR) AS cookie,
  CAST(event_id AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS did, CAST(event_id AS VARCHAR) AS imp_id,
  placement_id, d, h
FROM tracking WHERE source IN ('letv', 'baidu_bc', 'youku', 'tencent', 'iqiyi')""",
    "tracking_rejects": _with(TRACKING) + """
SELECT CASE WHEN event_id % 5 = 1 THEN concat(d, lpad(CAST(h AS VARCHAR), 2, '0'), chr(9), '-', chr(9), 'no json ', event_id)
  ELSE concat(d, lpad(CAST(h AS VARCHAR), 2, '0'), chr(9), event_id) END AS value
FROM tracking WHERE event_id % 5 = 1 OR event_id % 7 = 2""",
    "stream_rows_dirty": _with(TRACKING) + f"""
SELECT client_id, group_id, ad_id, creative_id,
  CASE WHEN event_id % 11 = 0 THEN concat('t', tag_id) ELSE tag_id END AS tag_id, channel_id, placement_id, source,
  {PLATFORM} AS platform, event, CAST(coalesce(price, 0) AS DOUBLE) AS price, d, h
FROM tracking WHERE event_id % 13 <> 0 AND event_id % 5 <> 1 AND event_id % 7 <> 2 AND event_id % 9 <> 4""",
    **{name: _with(TRACKING) + _finished(_counts(keys)) for name, keys in REPORT_KEYS.items()},
    "reports_from_rollup": _with(TRACKING) + " UNION ALL ".join(
        f"""SELECT '{name}' AS report, count(*) AS rows, CAST(sum(impression) AS BIGINT) AS impression,
 CAST(sum(billed) AS DOUBLE) AS billed
 FROM ({_counts(keys)}) WHERE impression > 0 AND billed > 0""" for name, keys in REPORT_KEYS.items()
    ),
    "stream_billing_report": _with(TRACKING)
    + _finished(_counts("client_id, group_id", STREAM_BILLED), positive=False),
    "batch_time_bounds": _with(TRACKING) + """
SELECT f.d AS first_d, f.h AS first_h, l.d AS last_d, l.h AS last_h
FROM (SELECT d, h FROM tracking ORDER BY d, h LIMIT 1) f,
 (SELECT d, h FROM tracking ORDER BY d DESC, h DESC LIMIT 1) l""",
    "traffic_daily": _with(BIDS) + f"""
SELECT {DAY} AS day, coalesce(tagid, '-') AS placement, channel,
 CASE device_type WHEN 0 THEN 'Mobile' WHEN 1 THEN 'PC' ELSE 'Tablet' END AS device, {OS} AS system,
 width, height, count(*) AS count, 'youku' AS platform
FROM bids GROUP BY ALL""",
    "traffic_dynamic_youku": _with(BIDS) + f"""
SELECT {DAY} AS day, h AS hour, '优酷视频' AS platform, {ON_DEMAND_DEVICE} AS device, channel,
 {SIZE} AS size, {OS} AS os, count(*) AS count
FROM bids WHERE d BETWEEN '20240103' AND '20240125' AND device_type IN (0, 1)
 AND {OS} IN ('IOS', 'Android', 'Windows') AND channel IN ('c0', 'c1', 'c2', 'c3', 'c4')
 AND {SIZE} IN ('640x480', '1280x720') GROUP BY ALL""",
    "traffic_dynamic_placement": _with(BIDS) + f"""
SELECT placementid, tagid, {DAY} AS day, count(*) AS count
FROM bids WHERE d BETWEEN '20240101' AND '20240131' AND tagid IN ('1', '2', '3', '5', '8', '13')
 AND placementid IN ('p1', 'p2', 'p3', 'p5', 'p8') GROUP BY ALL""",
    "traffic_dynamic_iqiyi": _with(BIDS) + f"""
SELECT {DAY} AS day, h AS hour, '爱奇艺' AS platform, count(*) AS count
FROM bids WHERE d BETWEEN '20240101' AND '20240120' GROUP BY ALL""",
    "traffic_from_rollup": _with(BIDS) + f"""
SELECT 'full' AS request, {DAY} AS day, h AS hour, '优酷视频' AS platform, {ON_DEMAND_DEVICE} AS device, channel,
 {SIZE} AS size, {OS} AS os, count(*) AS count, NULL::VARCHAR AS tagid, NULL::VARCHAR AS placementid
FROM bids WHERE d BETWEEN '20240103' AND '20240125' AND device_type IN (0, 1)
 AND {OS} IN ('IOS', 'Android', 'Windows') AND channel IN ('c0', 'c1', 'c2', 'c3', 'c4')
 AND {SIZE} IN ('640x480', '1280x720') GROUP BY ALL
UNION ALL BY NAME SELECT 'placement' AS request, placementid, tagid, {DAY} AS day, count(*) AS count
FROM bids WHERE d BETWEEN '20240101' AND '20240131' AND tagid IN ('1', '2', '3', '5', '8', '13')
 AND placementid IN ('p1', 'p2', 'p3', 'p5', 'p8') GROUP BY ALL
UNION ALL BY NAME SELECT 'plain' AS request, {DAY} AS day, h AS hour, '爱奇艺' AS platform, count(*) AS count
FROM bids WHERE d BETWEEN '20240101' AND '20240120' GROUP BY ALL""",
    "json_inferred": """
SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN CAST(event_id % 100 AS VARCHAR) WHEN 1 THEN event_type END AS v,
 CASE event_id % 4 WHEN 1 THEN user_id END AS user, CASE event_id % 4 WHEN 0 THEN event_id % 7 END AS k,
 CASE event_id % 4 WHEN 2 THEN CAST(event_id % 8 AS DOUBLE) / 8 END AS w
FROM (SELECT event_type, user_id, CASE WHEN event_id % 4 < 3 THEN event_id END AS event_id FROM events)""",
    "reach_estimate": _with(BIDS, REACH) + f"""
SELECT 'youku' AS platform, channel, hour, count(*) AS count FROM reach
WHERE channel IN ('c0', 'c1', 'c2', '{TV_CHANNELS[0]}', 'c5') AND device IN ('Mobile', 'PC') AND size = '640x480'
 AND (placementid IN ('augc', 'atv', 'kugc', 'ktv', 'zugc', 'ztv')
  OR TRY_CAST(placementid AS INT) BETWEEN 1 AND 10)
GROUP BY channel, hour""",
    "reach_json": _with(BIDS, REACH) + """
SELECT CAST(0 AS BIGINT) AS "at", '{"id":7,"data":[' AS fragment
UNION ALL SELECT "at", concat(CASE WHEN "at" > 1 THEN ',' ELSE '' END, '{"platform":"youku","channel":"', channel,
 '","hour":', hour, ',"count":', n, '}')
 FROM (SELECT *, row_number() OVER (ORDER BY channel, hour) AS "at"
  FROM (SELECT channel, hour, count(*) AS n FROM reach GROUP BY channel, hour))
UNION ALL SELECT count(*) + 1, ']}' FROM (SELECT DISTINCT channel, hour FROM reach)""",
    "keyword_pv": _with(DELIVERIES, PACK, KEYWORD_ROWS) + """
SELECT system, keyword, count(*) AS pv FROM words JOIN pack USING (keyword)
WHERE system <> '-' GROUP BY system, keyword""",
    "keyword_pv_from_packs": _with(DELIVERIES, KEYWORD_ROWS, """pack AS (
 SELECT p_brand AS keyword FROM part WHERE p_partkey % 2 = 0
 UNION SELECT split_part(p_name, ' ', 1) FROM part WHERE p_partkey % 3 = 0)""") + """
SELECT system, keyword, count(*) AS pv FROM words JOIN pack USING (keyword)
WHERE system <> '-' GROUP BY system, keyword""",
    "systems_by_function": _with(BIDS) + f"SELECT {OS} AS system, count(*) AS n FROM bids GROUP BY ALL",
    "channel_keyword_pv": _with(DELIVERIES, PACK, KEYWORD_ROWS) + """
SELECT system, channel, keyword, count(*) AS pv FROM words JOIN pack USING (keyword)
WHERE system <> '-' AND channel <> '' AND keyword <> '' GROUP BY system, channel, keyword""",
    "keyword_pairs": _with(DELIVERIES, PACK, PAIRS) + "SELECT a, b, n FROM pairs",
    "keyword_relations": _with(DELIVERIES, PACK, PAIRS) + """
SELECT keyword, neighbour, CAST(sum(n) AS BIGINT) AS n,
 CAST(sum(sum(n)) OVER (PARTITION BY keyword) AS BIGINT) AS total
FROM (SELECT a AS keyword, b AS neighbour, n FROM pairs UNION ALL SELECT b, a, n FROM pairs)
GROUP BY keyword, neighbour""",
    "keyword_pairs_large_pack": _with(DELIVERIES, AD_PACK, PAIRS.replace("FROM pack", "SELECT keyword FROM ad_pack"))
    + "SELECT a, b, n FROM pairs",
    "relation_json": _with(DELIVERIES, PACK, PAIRS) + r"""
, links AS (SELECT concat(keyword[:3], '"\', keyword[4:]) AS keyword, concat(neighbour[:3], '"\', neighbour[4:]) AS neighbour,
  CAST(sum(n) AS BIGINT) AS n
 FROM (SELECT a AS keyword, b AS neighbour, n FROM pairs UNION ALL SELECT b, a, n FROM pairs) GROUP BY ALL),
quoted AS (SELECT *, replace(replace(keyword, '\', '\\'), '"', '\"') AS k, replace(replace(neighbour, '\', '\\'), '"', '\"') AS m FROM links)
SELECT keyword, 0 AS part, NULL::VARCHAR AS neighbour, concat('"', any_value(k), '":{"relation":{') AS fragment FROM quoted GROUP BY keyword
UNION ALL SELECT keyword, 1, neighbour, concat(CASE WHEN neighbour = min(neighbour) OVER (PARTITION BY keyword) THEN '' ELSE ',' END,
 '"', m, '":', n) FROM quoted
UNION ALL SELECT keyword, 2, NULL, concat('},"total":', CAST(sum(n) AS BIGINT), '}') FROM quoted GROUP BY keyword""",
    "keyword_first_match": _with(DELIVERIES, VALID) + _first_match(FIRST_IN_PACK),
    "keyword_hour_report": _scoped(
        """SELECT d, h, list(DISTINCT keyword) AS words
 FROM (SELECT DISTINCT d, h, ad_id FROM deliveries WHERE request_time <> 0) JOIN ad_pack USING (ad_id)
 GROUP BY d, h""",
        "v.d = s.d AND v.h = s.h",
    ),
    "keyword_hour_report_per_ad": _scoped(
        "SELECT ad_id, list(keyword) AS words FROM ad_pack GROUP BY ad_id", "v.ad_id = s.ad_id"
    ),
    "keyword_kpis": _with(DELIVERIES, VALID, f"first AS ({_first_match(FIRST_IN_PACK)})") + f"""
SELECT keyword, impression, click, {_half_up('cost', '100')} AS cost,
 {_half_up('click * 100', 'impression')} AS ctr, {_half_up('cost * 10', 'impression')} AS cpm
FROM (SELECT keyword, CAST(sum(impression) AS BIGINT) AS impression,
 CAST(sum(click) AS BIGINT) AS click, CAST(sum(cost) AS BIGINT) AS cost FROM first GROUP BY keyword)""",
    "keyword_kpis_request": _with(DELIVERIES, VALID, f"first AS ({_first_match(FIRST_IN_PACK)})") + f"""
SELECT keyword, impression, click, {_half_up('cost', '100')} AS cost,
 {_half_up('click * 100', 'impression')} AS ctr, {_half_up('cost * 10', 'impression')} AS cpm
FROM (SELECT keyword, CAST(sum(impression) AS BIGINT) AS impression,
 CAST(sum(click) AS BIGINT) AS click, CAST(sum(cost) AS BIGINT) AS cost FROM first WHERE d BETWEEN '19940101' AND '19961231' AND ad_id = '7' AND platform = 'O' GROUP BY keyword)""",
    "device_profile": _with(BIDS, USED, DEVICES) + "SELECT * FROM devices",
    "device_profile_rolling": _with(BIDS, *_ranges()) + " UNION ALL ".join(
        f"SELECT *, '{start}' AS start FROM devices{start}" for start, _ in RANGES
    ),
    "ip_profile": _with(BIDS, USED, IPS) + "SELECT * FROM ips",
    "device_scores": _with(BIDS, USED, DEVICES, DEVICE_SCORED) + _score_rows("device_scored", DEVICE_FEATURES),
    "ip_scores": _with(BIDS, USED, IPS, IP_SCORED) + _score_rows("ip_scored", IP_FEATURES),
    "device_histogram": _with(BIDS, USED, DEVICES, DEVICE_SCORED) + _bins("device_scored"),
    "ip_histogram": _with(BIDS, USED, IPS, IP_SCORED) + _bins("ip_scored"),
    "ip_blocklist": _with(BIDS, USED, IPS) + """
SELECT concat('blk:', ip) AS name, vcount AS videos, idfacount AS devices, '20240228' AS expires_at
FROM ips WHERE vcount > 290 OR idfacount > 110""",
    "device_blocklist": _with(BIDS, USED, DEVICES) + """
SELECT idfa AS name, vcount AS videos, '20240228' AS expires_at FROM devices WHERE vcount > 50""",
    "low_probability_blocklist": _with(BIDS, USED, DEVICES, IPS, DEVICE_SCORED, IP_SCORED) + """
SELECT name, 'idfa' AS target FROM device_scored WHERE p < 0.1
UNION ALL SELECT concat('blk:', name), 'ip' FROM ip_scored WHERE p < 1e-4""",
    "report_merge": _halves(_finished(
        f"SELECT {ALL_SLICE}, {SUMS} FROM (SELECT * FROM old UNION ALL SELECT * FROM new) GROUP BY {ALL_SLICE}",
        positive=False,
    )),
    "report_new_rows": _halves(_finished(
        f"SELECT * FROM new ANTI JOIN old USING ({ALL_SLICE})", positive=False
    )),
    "report_stored_beside": _halves(
        f"SELECT {', '.join(f'new.{c.strip()}' for c in ALL_SLICE.split(','))}, new.impression, old.impression AS stored_impression, "
        f"CAST(old.billed AS DOUBLE) AS stored_billed FROM new LEFT JOIN old USING ({ALL_SLICE})"
    ),
    "report_updated_rows": _halves(_finished(
        f"SELECT {ALL_SLICE}, {', '.join(f'new.{c} + old.{c} AS {c}' for c in COUNTERS)} "
        f"FROM new JOIN old USING ({ALL_SLICE})",
        positive=False,
    )),
    "report_merge_buckets": _halves(_finished(
        f"SELECT {ALL_SLICE}, {SUMS} FROM (SELECT * FROM old UNION ALL SELECT * FROM new) GROUP BY {ALL_SLICE}",
        positive=False,
    )),
    "partition_switch": _with(TRACKING) + _finished(
        _counts("client_id", where=f"d >= '20240112' AND NOT d BETWEEN '{BOUNDARY}' AND '20240118'") + " UNION ALL "
        + _counts("client_id", STREAM_BILLED, f"d BETWEEN '{BOUNDARY}' AND '20240118'"),
        positive=False,
    ),
    "active_day_report": _with(TRACKING) + _finished(
        _counts("client_id", where=f"d IN (SELECT d FROM tracking WHERE ad_id = {ACTIVE_AD} AND event = 6)"), positive=False
    ),
    "partition_replace": _with(TRACKING) + _finished(
        _counts("client_id", where=f"d < '{BOUNDARY}'") + " UNION ALL "
        + _counts("client_id", STREAM_BILLED, f"d >= '{BOUNDARY}'"),
        positive=False,
    ),
    "stream_report": _with(TRACKING) + _finished(STREAM_COUNTS, positive=False),
    "stream_state_report": _with(TRACKING) + _finished(STREAM_COUNTS, positive=False),
    "stream_report_folded": _with(TRACKING) + _finished(STREAM_COUNTS, positive=False),
    "stream_replay_safe": _with(TRACKING) + _finished(STREAM_COUNTS, positive=False),
    "stream_from_offsets": _with(
        TRACKING.replace("tracking AS", "every AS", 1),
        f"""tracking AS (
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY d ORDER BY event_id) AS line FROM every)
 WHERE d > '{START_DAY}' OR (d = '{START_DAY}' AND line > {START_LINE}))""",
    ) + _finished(STREAM_COUNTS, positive=False),
    "stream_limited": _with(TRACKING) + f"SELECT *, CAST({LIMITED_FILES} AS BIGINT) AS batches FROM ({_finished(STREAM_COUNTS, positive=False)})",
    "stream_pane_counts": """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
 strftime(w + INTERVAL 60 SECOND, '%Y-%m-%d %H:%M:%S') AS window_end, word, count(*) AS n
FROM (SELECT unnest([event_type, 'any']) AS word,
  time_bucket(INTERVAL 10 SECOND, ts) - INTERVAL 10 SECOND * back AS w
 FROM events, (SELECT unnest(range(6)) AS back)) GROUP BY w, word""",
    "stream_sliding_counts": """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
 strftime(w + INTERVAL 20 SECOND, '%Y-%m-%d %H:%M:%S') AS window_end, word, count(*) AS n
FROM (SELECT unnest([event_type, 'any']) AS word,
  time_bucket(INTERVAL 10 SECOND, ts) - INTERVAL 10 SECOND * back AS w
 FROM events, (SELECT unnest([0, 1]) AS back)) GROUP BY w, word""",
    "feature_index": _with(DELIVERIES, INDEX) + "SELECT feature, idx FROM feature_ids",
    "labelled_rows": _with(DELIVERIES, LABELLED)
    + "SELECT click_uuid, subchannel, creative_id, label FROM labelled",
    "libsvm_rows": _with(DELIVERIES, INDEX, LABELLED) + """
SELECT concat_ws(' ', CAST(label AS VARCHAR), concat(a.idx, ':1'), concat(b.idx, ':1')) AS value
FROM labelled LEFT JOIN feature_ids a ON a.feature = concat('sc_', subchannel)
 LEFT JOIN feature_ids b ON b.feature = concat('cr_', creative_id)""",
    "ctr_split": _with(DELIVERIES, LABELLED) + """
SELECT CASE WHEN CAST(concat('0x', left(md5(CAST(click_uuid AS VARCHAR)), 8)) AS BIGINT) % 1000 < 800 THEN 'train' ELSE 'test' END AS part,
 subchannel, count(*) AS n, CAST(sum(label) AS BIGINT) AS converted FROM labelled GROUP BY ALL""",
    "ctr_auc": _with(DELIVERIES, LABELLED) + """
, scored AS (SELECT label, price AS score FROM labelled),
points AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM scored GROUP BY score),
curve AS (
 SELECT *, sum(p) OVER high AS tp, sum(n) OVER high AS fp, sum(p) OVER () AS all_p, sum(n) OVER () AS all_n
 FROM points WINDOW high AS (ORDER BY score DESC)),
steps AS (
 SELECT tp / all_p AS recall, tp / (tp + fp) AS precision, tp / all_p AS y, fp / all_n AS x,
  lag(tp / all_p, 1, 0) OVER w AS recall0, lag(tp / (tp + fp)) OVER w AS precision0,
  lag(tp / all_p, 1, 0) OVER w AS y0, lag(fp / all_n, 1, 0) OVER w AS x0
 FROM curve WINDOW w AS (ORDER BY score DESC))
SELECT 'auPRC' AS metric, round(sum((recall - recall0) * (precision + coalesce(precision0, precision)) / 2), 6) AS value FROM steps
UNION ALL SELECT 'auROC', round(sum((x - x0) * (y + y0) / 2), 6) FROM steps""",
    "ctr_optimum": _with(DELIVERIES, LABELLED) + """
, each AS (
 SELECT concat('sc_', subchannel) AS feature, label FROM labelled
 UNION ALL SELECT concat('cr_', creative_id), label FROM labelled)
SELECT feature, round(avg(label), 3) AS mean_label, round(avg(label), 3) AS mean_score FROM each GROUP BY feature""",
}
