"""Web requests and feature lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridscope_checks import domain as d
from gridscope_checks.registry import query
from gridscope.operators import features, weblocation as web

URIS = (
    "http://a.example/q?x={lng}&y={lat}",
    "http://a.example/q?s_x={lat}&s_y={lng}",
    "http://a.example/p?from_lat=%28null%29&from_lng=%28null%29&imsi=&lat={lat}&lng={lng}",
    "http://a.example/p?LAT={lat}&t=1&Lng={lng}&end=1",
    "http://a.example/p%3Flng%3d{lng}%26lat%3d{lat}",
    "http://a.example/p?v=lng%22%3a%22{lng}%22%2c%22lat%22%3a%22{lat}%22",
    "http://a.example/p?lon={lng}&lat={lat}",
    "http://a.example/p?lon=1.5&lon={lng}&lat={lat}&lat=2",
    "http://a.example/p?longitude={lng}&latitude={lat}",
    "http://a.example/p?pointx={lng}&pointy={lat}",
    "http://a.example/p?m={lat},{lng},5",
    "http://a.example/p?v=xy%22%3A%22{lat}%2c{lng}%22%2C%22w",
    "http://a.example/p?center={lat}%2C{lng}(12&z=3",
    "http://a.example/p?gps={lng},{lat}",
    "http://restapi.amap.com/v3?location={lng},{lat}",
    "http://a.example/p?location={lat},{lng}",
    "http://a.example/p?loc={lat},{lng},9",
    "http://a.example/p?points={lat},{lng}",
    "http://a.example/p?u=coords:{lat}_{lng},coords:{lng}_{lat},coords:a_b",
    "http://a.example/p?click={lng}%2c{lat}&click=1%25%2c2",
    "http://a.example/JW:{lng}|{lat}",
    "http://ps.map.baidu.com/s?sessid={lat},{lng}_{lng},{lat}|7,8,9_x,y&e=1",
    "http://a.example/p?lo={lng}&la={lat}",
    "http://a.example/p?d={lng}&l={lat}",
    "http://a.example/shop-lat{lat}-lng{lng}-z9",
    "http://a.example/nothing?k=1&b=2",
    "http://a.example/p?lng={lng}",
)

CONTENTS = (
    ("apilocate.amap.com", "<Cell><cenx>{lng}</cenx><ceny> {lat} </ceny><radius>25</radius></Cell>"),
    ("m5.amap.com", '{"code": "1", "tip_list": [{"tip": {"y": "{lat}", "x": "{lng}", "shortname": "s"}}]}'),
    ("M5.amap.com ", "<cenx>{lng}</cenx><ceny>{lat}</ceny>"),
    ("api.map.baidu.com",
     '{"status":0,"result":{"location":{"lng":{lng},"lat":{lat}},"confidence":25,"pois":[{"lng":1,"lat":2}]}}'),
    ("api.map.baidu.com", '{"status":0,"point":{"lng":{lng},"lat":{lat}}}'),
    ("loc.map.baidu.com", '{"content":{"clf":"1(2","point":{"x":"{lng}","y":"{lat}"},"radius":"66.4"},"cl":"1"}'),
    ("rd.go.10086.cn", '{"point":{"x":"{lng}","y":"{lat}"},"wf":"1"}'),
    ("restapi.amap.com", '{"route":{"origin":"{lng},{lat}","destination":"1,2"}}'),
    ("route.map.baidu.com", '{"result":{"location":{ "lng":{lng}, "lat":{lat} }}}'),
    ("trafficapp.autonavi.com:8888", "<event><lon>{lng}</lon><lat>{lat}</lat></event>"),
    ("www.example.com", "<cenx>{lng}</cenx><ceny>{lat}</ceny>"),
)

LAT_SQL = "'30.' || lpad(cast(event_id % 100000 as varchar), 5, '0')"
LNG_SQL = "'120.' || lpad(cast((event_id * 7) % 100000 as varchar), 5, '0')"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _pick_sql(texts) -> str:
    return (f"replace(replace((list_value({', '.join(_quote(t) for t in texts)}))[event_id % {len(texts)} + 1],"
            f" '{{lat}}', {LAT_SQL}), '{{lng}}', {LNG_SQL})")


LOGS = f"""
select 'e' || event_id id, {_pick_sql([h for h, _ in CONTENTS])} host, {_pick_sql(URIS)} uri,
 {_pick_sql([c for _, c in CONTENTS])} as content from events
union all select 'p' || page_id, split_part(url, '/', 3), url, html from pages
"""


def _pick(texts):
    event = F.col("event_id")
    lat = F.concat(F.lit("30."), F.lpad((event % 100000).cast("string"), 5, "0"))
    lng = F.concat(F.lit("120."), F.lpad((event * 7 % 100000).cast("string"), 5, "0"))
    chosen = F.element_at(F.array(*[F.lit(t) for t in texts]), (event % len(texts) + 1).cast("int"))
    return F.replace(F.replace(chosen, F.lit("{lat}"), lat), F.lit("{lng}"), lng)


def logs(spark, sf):
    events = d.table(spark, sf, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
        _pick([h for h, _ in CONTENTS]).alias("host"), _pick(URIS).alias("uri"),
        _pick([c for _, c in CONTENTS]).alias("content"))
    pages = d.table(spark, sf, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        F.get(F.split("url", "/"), F.lit(2)).alias("host"), F.col("url").alias("uri"), F.col("html").alias("content"))
    return events.unionByName(pages)


def _holds(item: str, key: str, start: bool = False) -> str:
    test = "starts_with" if start else "contains"
    return f"{test}(lower({item}), {_quote(key.lower())})"


def _after(item: str, key: str) -> str:
    return f"substr({item}, strpos(lower({item}), {_quote(key.lower())}) + {len(key)})"


def _parts(value: str, cut: str) -> str:
    return f"regexp_split_to_array(regexp_replace({value}, {_quote(f'(?:{cut})+$')}, ''), {_quote(cut)})"


def _point(lat: str, lng: str) -> str:
    return f"{{'lat': {lat}, 'lng': {lng}}}"


def _pair(value: str, cut: str, order: str, size: str) -> str:
    lat, lng = (1, 2) if order == "lat,lng" else (2, 1)
    parts = _parts(value, cut)
    return (f"case when len({parts}) {size} then "
            f"{_point(f'({parts})[{lat}]', f"split_part(({parts})[{lng}], '(', 1)")} end")


def _seen(items: str, first: str, second: str) -> tuple[str, str]:
    at = [f"coalesce(list_position(list_transform({items}, lambda i: {t}), true), 0)" for t in (first, second)]
    both = f"{at[0]} > 0 and {at[1]} > 0"
    stop = f"case when {at[0]} > {at[1]} then {at[0]} - 1 else {at[1]} end"
    return (f"case when {both} then list_filter(({items})[1:greatest({at[0]}, {at[1]})], lambda i: {first})[-1] end",
            f"case when {both} then list_filter(({items})[1:{stop}], lambda i: {second})[-1] end")


def _rule_sql(rule) -> str:
    if isinstance(rule, web.TwoKeys):
        lng, lat = _seen("items", _holds("i", rule.lng), _holds("i", rule.lat))
        point = _point(_after(f"({lat})", rule.lat), _after(f"({lng})", rule.lng))
        return f"case when ({lng}) is not null and ({lat}) is not null then [{point}] end"
    if isinstance(rule, web.PathParts):
        lat, lng = _seen("string_split(uri, '-')", "contains(i, 'lat')", "contains(i, 'lng')")
        point = _point(f"replace(({lat}), 'lat', '')", f"replace(({lng}), 'lng', '')")
        return f"case when contains(uri, '-lat') and contains(uri, '-lng') then [{point}] end"
    if isinstance(rule, web.OnePair):
        item = f"list_filter(items, lambda i: {_holds('i', rule.key, rule.at_start)})[1]"
        point = _pair(_after(item, rule.key), web.COMMA, rule.order, ">= 2" if rule.at_start else "= 2")
        host = _holds("uri", rule.host) if rule.host else "true"
        return f"case when {host} and ({point}) is not null then [{point}] end"
    items = f"regexp_split_to_array(uri, {_quote(rule.item_cut)})"
    named = f"list_filter({items}, lambda i: {_holds('i', rule.key)})"
    if isinstance(rule, web.PairList):
        values, applies = f"list_transform({named}, lambda i: {_after('i', rule.key)})", "true"
    else:
        values, applies = _parts(_after(f"({named})[1]", rule.key), rule.list_cut), _holds("uri", rule.host)
    pairs = f"list_filter(list_transform({values}, lambda v: {_pair('v', rule.pair_cut, rule.order, '= 2')}), " \
            "lambda p: p is not null)"
    bare = _point("replace(p.lat, '%', '')", "replace(p.lng, '%', '')")
    numeric = (f"list_filter(list_transform({pairs}, lambda p: {bare}), "
               "lambda p: try_cast(p.lat as double) is not null and try_cast(p.lng as double) is not null)")
    return f"case when {applies} and len({numeric}) > 0 then {numeric} end"


POINTS = f"""
select *, coalesce({', '.join(_rule_sql(r) for r in web.URI_RULES)}) points
from (select *, regexp_split_to_array(uri, {_quote(web.ITEM_CUT)}) items from logs) i
"""


def _tag(name: str) -> str:
    pattern = _quote(f"(?s)<{name}>(.*?)</{name}>")
    return f"case when regexp_matches(t, {pattern}) then trim(regexp_extract(t, {pattern}, 1)) end"


def _field(name: str) -> str:
    pattern = _quote(rf'(?:^|[,{{}}])\s*"{name}":\s*([^,{{}}]*)')
    return f"nullif(trim(replace(rtrim(regexp_extract(t, {pattern}, 1)), '\"', '')), '')"


def _answer(lng: str, lat: str, radius: str, kind: str, position: str = "null") -> str:
    return (f"case when ({lng}) is not null and ({lat}) is not null then {{'coord_type': '{kind}', "
            f"'longitude': {lng}, 'latitude': {lat}, 'radius': {radius}, "
            f"'position_type': cast({position} as varchar)}} end")


_ORIGIN = _quote(r'"origin":\s*"([^",{}]+),([^",{}]+)"')
_POSITION = "case " + " ".join(f"when contains(t, '\"{p}\"') then '{p}'" for p in web.POSITION_TYPES) + " end"
_BY_TAG = _answer(_tag("cenx"), _tag("ceny"), _tag("radius"), "BD")
_BY_XY = _answer(_field("x"), _field("y"), _field("radius"), "GCJ02")
_HOSTS = ", ".join(_quote(h) for h in web.TAG_HOSTS)
ANSWERS = f"""
select *, case
 when h = 'm5.amap.com' then coalesce({_BY_TAG}, {_BY_XY})
 when h in ({_HOSTS}) then {_BY_TAG}
 when h in ('api.map.baidu.com', 'route.map.baidu.com') then case when contains(t, '"location"') then
  {_answer(_field("lng"), _field("lat"), _field("confidence"), "BD")} end
 when h in ('loc.map.baidu.com', 'rd.go.10086.cn') then case when contains(t, '"point"') then
  {_answer(_field("x"), _field("y"), _field("radius"), "BD", _POSITION)} end
 when h = 'restapi.amap.com' then case when regexp_matches(t, {_ORIGIN}) then
  {_answer(f"regexp_extract(t, {_ORIGIN}, 1)", f"regexp_extract(t, {_ORIGIN}, 2)", _field("radius"), "GCJ02")} end
 when h = 'trafficapp.autonavi.com:8888' then {_answer(_tag("lon"), _tag("lat"), _tag("radius"), "GCJ02")}
 end answer
from (select *, lower(trim(host)) h, lower(content) t from points) p
"""


@query("x1_uri_location", f"""
with logs as ({LOGS}), points as ({POINTS})
select id, uri, points[1].lat as latitude, points[1].lng as longitude from points
""")
def uri_location(spark, sf):
    return web.uri_locations(logs(spark, sf).select("id", "uri"))


@query("x3_uri_location_rows", f"""
with logs as ({LOGS}), points as ({POINTS})
select id, uri, cast(k - 1 as integer) as position, points[k].lat as latitude, points[k].lng as longitude
from points, unnest(range(1, len(points) + 1)) e(k)
""")
def uri_location_rows(spark, sf):
    return web.uri_location_rows(logs(spark, sf).select("id", "uri"))


@query("x2_content_location", f"""
with logs as ({LOGS}), points as (select * from logs), answers as ({ANSWERS})
select id, answer is not null as success, answer.coord_type as coord_type, answer.longitude as longitude,
 answer.latitude as latitude, answer.radius as radius, answer.position_type as position_type from answers
""")
def content_location(spark, sf):
    return web.content_locations(logs(spark, sf)).drop("host", "uri", "content")


@query("c16_extract_locations", f"""
with logs as ({LOGS}), points as ({POINTS}), answers as ({ANSWERS})
select id, answer is not null or points[1] is not null as success, answer.coord_type as coord_type,
 case when answer is not null then answer.longitude else points[1].lng end as longitude,
 case when answer is not null then answer.latitude else points[1].lat end as latitude,
 answer.radius as radius, answer.position_type as position_type from answers
""")
def extract_locations(spark, sf):
    return web.extract_locations(logs(spark, sf)).drop("host", "uri", "content")


# Feature lines: list lengths run past the table's width, some features are absent.

_LIST_FEATURES = [n for n in features.FEATURES if features.is_list(n)]
_VALUE_FEATURES = [n for n in features.FEATURES if not features.is_list(n)]


def _multiples(number, count):
    return F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
                       lambda j: (number * j % 997).cast("string"))


def feature_lines(spark, sf):
    cust = F.col("c_custkey")
    parts = []
    for i, name in enumerate(features.FEATURES):
        shown = "LBS" if name == "lbs" else name
        if features.is_list(name):
            length = (cust + i) % 24
            values = F.concat_ws(" ", _multiples(cust + i, length))
            parts.append(F.when(length > 0, F.concat(F.lit(f"{shown} "), values)))
        else:
            parts.append(F.when((cust + i) % 7 != 0, F.concat(
                F.lit(f"{shown} "), (cust * (i + 1) % 1009).cast("string"), F.when(cust % 2 == 0, F.lit(" 77")).otherwise(F.lit("")))))
    # Each line is much work, and the keys of many may lie in one small file: they are dealt to all cores first.
    keys = d.table(spark, sf, "customer").select("c_custkey").repartition(4 * spark.sparkContext.defaultParallelism)
    return keys.select(F.concat_ws("|", *parts).alias("value"))


def _line_sql() -> str:
    parts = []
    for i, name in enumerate(features.FEATURES):
        shown = "LBS" if name == "lbs" else name
        if features.is_list(name):
            parts.append(f"case when (c_custkey + {i}) % 24 > 0 then '{shown} ' || array_to_string(list_transform("
                         f"range(1, (c_custkey + {i}) % 24 + 1), lambda j: cast((c_custkey + {i}) * j % 997 as varchar)), ' ') end")
        else:
            parts.append(f"case when (c_custkey + {i}) % 7 <> 0 then '{shown} ' || (c_custkey * {i + 1} % 1009) "
                         "|| case when c_custkey % 2 = 0 then ' 77' else '' end end")
    return f"select concat_ws('|', {', '.join(parts)}) as line from customer"


def _values(name: str) -> str:
    return (f"string_split(list_filter(string_split(line, '|'), "
            f"lambda i: lower(string_split(i, ' ')[1]) = '{name}')[1], ' ')")


PARSED = "select " + ", ".join(
    f"coalesce({_values(n)}[2:], ['0']) {n}" if features.is_list(n) else f"coalesce({_values(n)}[2], '0') {n}"
    for n in features.FEATURES) + " from lines"
WIDE = "select " + ", ".join(
    ", ".join(f"{n}[{i}] as {n}_{i}" for i in range(1, 21)) + f", {n}[21:] as {n}_rest" if features.is_list(n) else n
    for n in features.FEATURES) + " from parsed"


@query("s4_feature_lines", f"""
with lines as ({_line_sql()}), parsed as ({PARSED})
select {', '.join(_VALUE_FEATURES)}, {', '.join(f"array_to_string({n}, '#') as {n}" for n in _LIST_FEATURES)} from parsed
""")
def feature_table(spark, sf):
    parsed = features.parse_features(feature_lines(spark, sf))
    return parsed.select(*_VALUE_FEATURES, *[F.concat_ws("#", n).alias(n) for n in _LIST_FEATURES])


@query("c15_t3_user_features_wide", f"with lines as ({_line_sql()}), parsed as ({PARSED}) {WIDE}")
def user_features_wide(spark, sf):
    return features.user_features_wide(feature_lines(spark, sf))


@query("c15_feature_values", f"""
with lines as ({_line_sql()}),
items as (select line, unnest(list_filter(string_split(line, '|'), lambda i: contains(i, ' '))) as item,
                 unnest(range(1, len(list_filter(string_split(line, '|'), lambda i: contains(i, ' '))) + 1)) as n from lines),
parts as (select string_split(list_filter(string_split(line, '|'), lambda i: lower(i) like 'uid %')[1], ' ')[2] as uid,
                 lower(string_split(item, ' ')[1]) as feature, n, string_split(item, ' ')[2:] as found from items)
select uid, feature, n::int as item, unnest(range(1, len(found) + 1))::int as position, unnest(found) as value from parts
""")
def feature_values(spark, sf):
    return features.feature_values(feature_lines(spark, sf))
