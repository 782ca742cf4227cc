"""Coordinates in web requests and answers."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where a request is cut into items, and a value into two numbers.
ITEM_CUT = r"\?|%3F|%3f|&|%26|%22%2c%22|%22%2C%22|%22%7d%2c%7b%22|%22%7D%2C%7B%22|%7b%22|%3B|%3b|%257C"
LIST_ITEM_CUT = (r"\?|%3F|%3f|&|%26|%22%2c%22|%22%2C%22|%22%7d%2c%7b%22|%22%7D%2C%7B%22"
                 r"|%22%7d%5d|%22%7D%5D|%7b%22|%3B|%3b|%257C")
COMMA = r"%2C|%2c|,"
UNDERSCORE = "_"
UNDERSCORE_OR_BAR = r"_|\|"


@dataclass(frozen=True)
class TwoKeys:
    """Longitude and latitude under keys of their own."""

    lng: str
    lat: str


@dataclass(frozen=True)
class OnePair:
    """Both numbers under one key, in the order given; the first item with the key counts."""

    key: str
    order: str = "lat,lng"
    host: str = ""
    at_start: bool = False


@dataclass(frozen=True)
class PairList:
    """Every item with the key holds a pair; pairs that are not numbers are left out."""

    key: str
    item_cut: str = ITEM_CUT
    pair_cut: str = COMMA
    order: str = "lat,lng"


@dataclass(frozen=True)
class ListInItem:
    """The first item with the key holds a list of pairs."""

    key: str
    host: str = ""
    item_cut: str = "&"
    list_cut: str = UNDERSCORE_OR_BAR
    pair_cut: str = COMMA
    order: str = "lat,lng"


@dataclass(frozen=True)
class PathParts:
    """Latitude and longitude as marked parts of the path."""

    lat: str
    lng: str


# The rules in the order they are tried.
URI_RULES = (
    TwoKeys("s_y=", "s_x="),
    TwoKeys("x=", "y="),
    TwoKeys("lng=", "lat="),
    TwoKeys("lng%3d", "lat%3d"),
    TwoKeys("lng%3A", "lat%3A"),
    TwoKeys("lng%22%3a%22", "lat%22%3a%22"),
    TwoKeys("lon=", "lat="),
    TwoKeys("lon%3D", "lat%3D"),
    TwoKeys("don=", "lat="),
    TwoKeys("lgt=", "lat="),
    TwoKeys("longitude%22%3a%22", "latitude%22%3a%22"),
    TwoKeys("longitude=", "latitude="),
    TwoKeys("long=", "lat="),
    TwoKeys("MyPosx=", "MyPosy="),
    TwoKeys("pointx=", "pointy="),
    TwoKeys("lou%22%20:%20%22", "lau%22%20:%20%22"),
    TwoKeys("logi=", "lati="),
    OnePair("m=", at_start=True),
    PairList("xy%22%3A%22", item_cut=LIST_ITEM_CUT),
    OnePair("action_gps="),
    OnePair("cur_pt="),
    OnePair("center="),
    OnePair("cll="),
    OnePair("geoinfo="),
    OnePair("gps=", order="lng,lat"),
    OnePair("loc="),
    OnePair("location=", order="lng,lat", host="http://restapi.amap.com"),
    OnePair("location="),
    OnePair("latlng="),
    OnePair("mypos="),
    OnePair("origin="),
    OnePair("points="),
    OnePair("point="),
    OnePair("position="),
    OnePair("q="),
    OnePair("xyr="),
    PairList("coords:", item_cut=COMMA, pair_cut=UNDERSCORE),
    PairList("coords%3D", item_cut=COMMA, pair_cut=UNDERSCORE),
    PairList("click=", order="lng,lat"),
    PairList("start=", order="lng,lat"),
    PairList("JW%3A", item_cut=COMMA, pair_cut=UNDERSCORE_OR_BAR, order="lng,lat"),
    PairList("JW:", item_cut=COMMA, pair_cut=UNDERSCORE_OR_BAR, order="lng,lat"),
    ListInItem("sessid=", host="ps.map.baidu.com"),
    TwoKeys("lt%22%3A%22", "ltt%22%3A%22"),
    TwoKeys("lo=", "la="),
    TwoKeys("d=", "l="),
    TwoKeys("l=", "x="),
    TwoKeys("px=", "py="),
    PathParts("-lat", "-lng"),
)

# Answering hosts, by the form of their answer.
TAG_HOSTS = ("alipay.apilocate.amap.com", "apilocate.amap.com", "kdtaxi.apilocate.amap.com",
             "m5.amap.com", "taobao.apilocate.amap.com")
XY_HOST = "m5.amap.com"
LOCATION_HOSTS = ("api.map.baidu.com", "route.map.baidu.com")
POINT_HOSTS = ("loc.map.baidu.com", "rd.go.10086.cn")
ORIGIN_HOST = "restapi.amap.com"
TRAFFIC_HOST = "trafficapp.autonavi.com:8888"
POSITION_TYPES = ("wf", "cl", "ll")


def _cut(text: Column, pattern) -> Column:
    """Items of a text, each as it is and in lower case."""
    return F.transform(F.split(text, pattern),
                       lambda i: F.struct(i.alias("raw"), F.lower(i).alias("low")))


def _after(item: Column, key: Column) -> Column:
    return F.substring(item["raw"], F.position(key, item["low"]) + F.length(key), F.length(item["raw"]))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _point(lat: Column, lng: Column) -> Column:
    return F.struct(lat.alias("lat"), lng.alias("lng"))


def _parts(value: Column, cut: Column) -> Column:
    """Pieces of a value; separators at its end do not open a piece."""
    ending = F.concat(F.lit("(?:"), cut, F.lit(")+$"))
    return F.split(F.regexp_replace(value, ending, F.lit("")), cut)


def _pair(value: Column, cut: Column, lat_first: Column, least: Column | None = None) -> Column:
    """Point from exactly two pieces (or from ``least`` and more), else null.

    A longitude ends at a bracket.
    """
    def read(parts: Column) -> Column:
        lat = F.get(parts, F.when(lat_first, 0).otherwise(1))
        lng = F.get(parts, F.when(lat_first, 1).otherwise(0))
        size = F.size(parts)
        fits = size == 2 if least is None else (size == 2) | (size >= least)
        return F.when(fits, _point(lat, F.substring_index(lng, "(", 1)))

    return _let(_parts(value, cut), read)


def _bare(text: Column) -> Column:
    return F.replace(text, F.lit("%"), F.lit(""))


def _numeric_points(points: Column) -> Column:
    """Points that are numbers once percent signs are gone; null if none is left."""
    bare = F.transform(points, lambda p: _point(_bare(p["lat"]), _bare(p["lng"])))
    kept = F.filter(bare, lambda p: p["lat"].try_cast("double").isNotNull()
                    & p["lng"].try_cast("double").isNotNull())
    return _let(kept, lambda points: F.when(F.size(points) > 0, points))


def _last(items: Column, test) -> Column:
    return F.try_element_at(F.filter(items, test), F.lit(-1))


def _both(firsts: Column, seconds: Column) -> Column:
    """The two values a reader holds once both kinds of entries were seen, else null; entries are in order of their place.

    Later entries replace earlier ones until then. Of one item that is of both
    kinds, the first kind is read first.
    """
    def pick(held: Column) -> Column:
        one, two = (F.get(held[kind], F.lit(0))["place"] for kind in ("firsts", "seconds"))
        first_end = F.greatest(one, two)
        second_end = F.when(one > two, one - 1).otherwise(two)
        return F.when(one.isNotNull() & two.isNotNull(), F.struct(
            _last(held["firsts"], lambda e: e["place"] <= first_end)["value"].alias("first"),
            _last(held["seconds"], lambda e: e["place"] <= second_end)["value"].alias("second"),
        ))

    return _let(F.struct(firsts.alias("firsts"), seconds.alias("seconds")), pick)


def key_pattern(keys) -> str:
    """A pattern of all the keys that tries each common beginning once.

    No key may be the beginning of another, so that one key at most stands at each place.
    """
    tails: dict[str, list[str]] = {}
    for key in sorted(set(keys)):
        tails.setdefault(key[0], []).append(key[1:])
    parts = []
    for first, rest in tails.items():
        if "" in rest and len(rest) > 1:
            raise ValueError(f"a key is the beginning of another: {first}")
        sign = first if first.isascii() and first.isalnum() else f"\\{first}"
        parts.append(sign + (key_pattern(rest) if rest != [""] else ""))
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def _cut_pattern(cut: str) -> str:
    """The same cuts, each common beginning tried once; for lists of plain signs."""
    return key_pattern(cut.replace("\\?", "?").split("|"))


def _entries(items: Column, keys) -> Column:
    """Each key in each item: ``key``, ``place`` of the item (from 1), ``value`` after the key, whether it is ``leading``."""
    anywhere = F.lit(f"(?=({key_pattern(keys)}))")
    return F.flatten(F.transform(items, lambda item, i: F.transform(
        F.regexp_extract_all(item["low"], anywhere, F.lit(1)),
        lambda key: F.struct(key.alias("key"), (i + 1).alias("place"), _after(item, key).alias("value"),
                             item["low"].startswith(key).alias("leading")))))


def _single(point: Column) -> Column:
    """The point as an array of one; null if there is none."""
    return _let(point, lambda p: F.when(p.isNotNull(), F.array(p)))


def _rule_column(rule) -> Column:
    """A rule as a struct of constants, keys in lower case."""
    fields = {}
    for name, value in vars(rule).items():
        if name in ("key", "lng", "lat", "host") and not isinstance(rule, PathParts):
            value = value.lower()
        if name == "order":
            name, value = "lat_first", value == "lat,lng"
        fields[name] = F.lit(value)
    return F.struct(*[column.alias(name) for name, column in fields.items()])


class _Request:
    """Columns of one request that the rules look at: as it is, in lower case, and its entries by key."""

    def __init__(self, uri: Column, low: Column, entries: Column, strict: bool):
        self.uri, self.low, self.entries = uri, low, entries
        self.strict = strict

    def _named(self, item: Column, key: Column) -> Column:
        return item["low"].startswith(key) if self.strict else item["low"].contains(key)

    def _of(self, key: Column, leading: Column | None = None) -> Column:
        """Entries of a key, in order; only those that lead an item where that is wanted."""
        wanted = F.lit(True) if self.strict else F.lit(False) if leading is None else leading
        return F.filter(self.entries, lambda e: (e["key"] == key) & (e["leading"] | ~wanted))

    def _host(self, rule: Column) -> Column:
        return (rule["host"] == "") | self.low.contains(rule["host"])

    def applies(self, kind, rule: Column) -> Column:
        """A cheap test before values are read."""
        if kind is PathParts:
            return self.uri.contains(rule["lat"]) & self.uri.contains(rule["lng"])
        if kind is TwoKeys:
            return F.exists(self.entries, lambda e: e["key"] == rule["lng"]) & F.exists(self.entries, lambda e: e["key"] == rule["lat"])
        if kind is OnePair:
            return F.exists(self.entries, lambda e: e["key"] == rule["key"]) & self._host(rule)
        named = self.low.contains(rule["key"])
        return named if kind is PairList else named & self._host(rule)

    def points(self, kind, rule: Column) -> Column:
        """Array of points by a rule that applies; null if it finds none."""
        if kind is TwoKeys:
            both = _both(self._of(rule["lng"]), self._of(rule["lat"]))
            return _let(both, lambda found: F.when(found.isNotNull(), F.array(_point(found["second"], found["first"]))))
        if kind is PathParts:
            lat_word, lng_word = F.substring(rule["lat"], 2, 9), F.substring(rule["lng"], 2, 9)
            parts = F.transform(F.split(self.uri, "-"), lambda part, i: F.struct((i + 1).alias("place"), part.alias("value")))
            both = _both(F.filter(parts, lambda e: e["value"].contains(lat_word)),
                         F.filter(parts, lambda e: e["value"].contains(lng_word)))
            return _let(both, lambda found: F.when(found.isNotNull(), F.array(_point(
                F.replace(found["first"], lat_word, F.lit("")), F.replace(found["second"], lng_word, F.lit(""))))))
        if kind is OnePair:
            value = F.get(self._of(rule["key"], rule["at_start"]), F.lit(0))["value"]
            least = F.when(rule["at_start"], 2)
            return _single(_pair(value, F.lit(COMMA), rule["lat_first"], least))
        named = F.filter(_cut(self.uri, rule["item_cut"]), lambda i: self._named(i, rule["key"]))
        if kind is PairList:
            values = F.transform(named, lambda i: _after(i, rule["key"]))
        else:
            value = _let(F.get(named, F.lit(0)), lambda i: _after(i, rule["key"]))
            values = _parts(value, rule["list_cut"])
        pairs = F.transform(values, lambda v: _pair(v, rule["pair_cut"], rule["lat_first"]))
        return _numeric_points(F.filter(pairs, lambda p: p.isNotNull()))

    def first_points(self, kind, rules) -> Column:
        """Points by the first of several rules of one kind."""
        listed = F.array(*[_rule_column(rule) for rule in rules])
        tried = F.transform(F.filter(listed, lambda rule: self.applies(kind, rule)),
                            lambda rule: self.points(kind, rule))
        first = F.get(F.filter(tried, lambda points: points.isNotNull()), F.lit(0))
        return F.when(F.size(self.entries) > 0, first) if kind in (TwoKeys, OnePair) else first


def _looked_up(rules) -> list[str]:
    """Keys that are looked up among the entries of a request, in lower case."""
    keys = [key for rule in rules if isinstance(rule, TwoKeys) for key in (rule.lng, rule.lat)]
    return [key.lower() for key in keys + [rule.key for rule in rules if isinstance(rule, OnePair)]]


def _any_key(rules) -> str:
    """A pattern that every request with a point has somewhere in lower case."""
    return key_pattern((rule.lat if isinstance(rule, (TwoKeys, PathParts)) else rule.key).lower() for rule in rules)


def with_uri_points(logs: DataFrame, uri: str = "uri", name: str = "points", strict: bool = False,
                    rules=URI_RULES, wanted: Column | None = None) -> DataFrame:
    """Adds the points of a request as an array, by the first rule that yields any.

    Keys count anywhere in an item; ``strict`` wants them at its start. A request is cut once and all keys in its
    items are found by one pattern; the rules look them up. A request without any key, or one that is
    not ``wanted``, is not taken apart.
    """
    low = F.lower(F.col(uri))
    asked = low.rlike(_any_key(rules)) if wanted is None else wanted & low.rlike(_any_key(rules))
    prepared = logs.withColumn("_low", F.when(asked, low)) \
        .withColumn("_entries", F.when(F.col("_low").isNotNull(), _entries(_cut(F.col(uri), _cut_pattern(ITEM_CUT)), _looked_up(rules))))
    request = _Request(F.col(uri), F.col("_low"), F.col("_entries"), strict)
    runs = [request.first_points(kind, list(run)) for kind, run in groupby(rules, type)]
    return prepared.withColumn(name, F.when(F.col("_low").isNotNull(), F.coalesce(*runs))).drop("_low", "_entries")


def uri_locations(logs: DataFrame, strict: bool = False) -> DataFrame:
    """First point of each request, null if it has none."""
    first = F.get("points", F.lit(0))
    return (
        with_uri_points(logs, strict=strict)
        .withColumn("latitude", first["lat"]).withColumn("longitude", first["lng"])
        .drop("points")
    )


def uri_location_rows(logs: DataFrame, strict: bool = False) -> DataFrame:
    """One row per point of a request."""
    rows = with_uri_points(logs, strict=strict)
    kept = [c for c in rows.columns if c != "points"]
    # The outer form keeps the optimizer from computing the points a second time as a filter.
    return (
        rows.select(*kept, F.posexplode_outer("points").alias("position", "_point"))
        .where(F.col("position").isNotNull())
        .select(*kept, "position", F.col("_point.lat").alias("latitude"), F.col("_point.lng").alias("longitude"))
    )


def _tag(content: Column, name: str) -> Column:
    found = F.regexp_extract(content, f"(?s)<{name}>(.*?)</{name}>", 1)
    return F.when(content.rlike(f"(?s)<{name}>.*?</{name}>"), F.trim(found))


def _json_field(content: Column, name: str) -> Column:
    """First value of a field, without quotes; null if there is none."""
    found = F.regexp_extract(content, rf'(?:^|[,{{}}])\s*"{name}":\s*([^,{{}}]*)', 1)
    bare = F.trim(F.replace(F.regexp_replace(found, r"\s+$", ""), F.lit('"'), F.lit("")))
    return F.when(bare != "", bare)


def _answer(lng: Column, lat: Column, radius: Column, coord_type: str,
            position_type: Column | None = None) -> Column:
    position_type = F.lit(None).cast("string") if position_type is None else position_type
    return F.when(lng.isNotNull() & lat.isNotNull(), F.struct(
        F.lit(coord_type).alias("coord_type"), lng.alias("longitude"), lat.alias("latitude"),
        radius.alias("radius"), position_type.alias("position_type")))


def content_location(host, content) -> Column:
    """Struct of the location in a web answer, null if the host or the answer gives none."""
    host, text = F.lower(F.trim(F.col(host))), F.lower(F.col(content))
    position_type = F.coalesce(*[F.when(text.contains(f'"{t}"'), F.lit(t)) for t in POSITION_TYPES])
    by_tag = _answer(_tag(text, "cenx"), _tag(text, "ceny"), _tag(text, "radius"), "BD")
    by_xy = _answer(_json_field(text, "x"), _json_field(text, "y"), _json_field(text, "radius"), "GCJ02")
    by_location = F.when(text.contains('"location"'), _answer(
        _json_field(text, "lng"), _json_field(text, "lat"), _json_field(text, "confidence"), "BD"))
    by_point = F.when(text.contains('"point"'), _answer(
        _json_field(text, "x"), _json_field(text, "y"), _json_field(text, "radius"), "BD", position_type))
    origin = r'"origin":\s*"([^",{}]+),([^",{}]+)"'
    by_origin = F.when(text.rlike(origin), _answer(
        F.regexp_extract(text, origin, 1), F.regexp_extract(text, origin, 2),
        _json_field(text, "radius"), "GCJ02"))
    by_traffic = _answer(_tag(text, "lon"), _tag(text, "lat"), _tag(text, "radius"), "GCJ02")
    return (
        F.when(host == XY_HOST, F.coalesce(by_tag, by_xy))
        .when(host.isin(*TAG_HOSTS), by_tag)
        .when(host.isin(*LOCATION_HOSTS), by_location)
        .when(host.isin(*POINT_HOSTS), by_point)
        .when(host == ORIGIN_HOST, by_origin)
        .when(host == TRAFFIC_HOST, by_traffic)
    )


ANSWER_FIELDS = ("coord_type", "longitude", "latitude", "radius", "position_type")


def content_locations(logs: DataFrame) -> DataFrame:
    """X2 as columns, with a success mark."""
    found = logs.withColumn("_found", content_location("host", "content"))
    return found.select(*logs.columns, F.col("_found").isNotNull().alias("success"),
                        *[F.col(f"_found.{f}").alias(f) for f in ANSWER_FIELDS])


def extract_locations(logs: DataFrame, strict: bool = False) -> DataFrame:
    """The location of each log row, from the answer or else from the request."""
    answered = logs.withColumn("_found", content_location("host", "content"))
    rows = with_uri_points(answered, strict=strict, wanted=F.col("_found").isNull())
    point = F.get("points", F.lit(0))
    located = F.col("_found").isNotNull()
    return rows.select(
        *logs.columns,
        (located | point.isNotNull()).alias("success"),
        F.col("_found.coord_type").alias("coord_type"),
        F.when(located, F.col("_found.longitude")).otherwise(point["lng"]).alias("longitude"),
        F.when(located, F.col("_found.latitude")).otherwise(point["lat"]).alias("latitude"),
        F.col("_found.radius").alias("radius"),
        F.col("_found.position_type").alias("position_type"),
    )
