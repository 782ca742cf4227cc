"""Column functions on whole tables (F, G and K rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridscope_checks import domain as d
from gridscope_checks.domain_sql import GRID_LAT, GRID_LON, with_tables
from gridscope_checks.registry import query
from gridscope.functions import codes, geo, sql_names, text


def _lines(spark, sf):
    return d.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


@query("f1_floor_to", """
select l_orderkey, l_linenumber, l_extendedprice,
 round(cast(floor(l_extendedprice * 10) as bigint) / 10.0::double, 6) as cut_one,
 round(cast(floor(l_extendedprice / 7 * 1000) as bigint) / 1000.0::double, 6) as cut_three from lineitem
""")
def floor_to(spark, sf):
    return _lines(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.round(codes.floor_to("l_extendedprice", 1), 6).alias("cut_one"),
        F.round(codes.floor_to(F.col("l_extendedprice") / 7, 3), 6).alias("cut_three"))


@query("f2_log10", """
select c_custkey, case when c_acctbal > 0 then round(log10(c_acctbal), 8) end as magnitude from customer
""")
def log10(spark, sf):
    return d.table(spark, sf, "customer").select("c_custkey", F.round(codes.log10("c_acctbal"), 8).alias("magnitude"))


@query("f3_millis_between", """
select event_id, (epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) // 1000 as millis from events
""")
def millis_between(spark, sf):
    return d.table(spark, sf, "events").select(
        "event_id", codes.millis_between(F.lit("2024-01-01 00:00:00").cast("timestamp"), "ts").alias("millis"))


@query("f4_add_seconds", """
select event_id, strftime(ts + to_seconds(cast(event_id % 5000 as integer) * 1000), '%Y-%m-%d %H:%M:%S') as later
from events
""")
def add_seconds(spark, sf):
    later = codes.add_seconds("ts", (F.col("event_id") % 5000 * 1000).cast("int"))
    return d.table(spark, sf, "events").select("event_id", F.date_format(later, "yyyy-MM-dd HH:mm:ss").alias("later"))


@query("f5_antenna_to_objectid", with_tables("raw_long", """
select google_gci, google_gri, grid_height, k as slot, antenna,
 cast(case when antenna is null then null when antenna not like '%\\_%' escape '\\' or antenna like '%a%' then 0
  else cast(split_part(antenna, '_', 1) as integer) * 256 + cast(split_part(antenna, '_', 2) as integer) end as integer)
  as objectid from raw_long
"""))
def antenna_to_objectid(spark, sf):
    slots = F.array(*[F.struct(F.lit(k).cast("bigint").alias("slot"), F.col(f"antenna_{k}").alias("antenna"))
                      for k in range(7)])
    return d.finger_raw(spark, sf).select("google_gci", "google_gri", "grid_height", F.inline(slots)) \
        .withColumn("objectid", codes.antenna_to_objectid("antenna"))


@query("f6_join_row_column_id", """
select l_orderkey, l_linenumber, cast(cast(l_orderkey as varchar) || cast(l_linenumber as varchar) as bigint) as joined
from lineitem
""")
def join_row_column_id(spark, sf):
    return _lines(spark, sf).select("l_orderkey", "l_linenumber",
                                    codes.join_row_column_id("l_orderkey", "l_linenumber").alias("joined"))


@query("f7_difference_weight", """
select l_orderkey, l_linenumber, l_quantity, cast(case
 when l_quantity / 2 <= 4 then 10 when l_quantity / 2 <= 8 then 9 when l_quantity / 2 <= 9 then 8
 when l_quantity / 2 <= 10 then 7 when l_quantity / 2 <= 11 then 6 when l_quantity / 2 <= 12 then 5
 when l_quantity / 2 <= 13 then 4 when l_quantity / 2 <= 14 then 3 else 0 end as integer) as weight
from lineitem
""")
def difference_weight(spark, sf):
    return _lines(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity",
                                    codes.difference_weight(F.col("l_quantity") / 2).alias("weight"))


@query("f8_salted_sum", with_tables("mro", """
select objectid, cast(sum(ltescrsrp) as bigint) as total, count(*) as rows from mro group by 1
"""))
def salted_sum(spark, sf):
    return codes.salted_sum(d.mro(spark, sf), "objectid", "ltescrsrp", "mmeues1apid", "ncellobjectid")


@query("f8_salt_and_unsalt", with_tables("mro", "select objectid, count(*) as rows from mro group by 1"))
def salt_and_unsalt(spark, sf):
    salted = d.mro(spark, sf).select(codes.salt_key("objectid", "mmeues1apid").alias("salted"))
    return salted.groupBy(codes.unsalt_key("salted").cast("bigint").alias("objectid")) \
        .agg(F.count(F.lit(1)).alias("rows"))


@query("f9_signal_decoding", with_tables("mro", """
select mmeues1apid, ncellobjectid, ltescrsrp - 141 as dbm,
 case when ltescrsrq = -999 then null else ltescrsrq / 2.0::double - 20 end as rsrq,
 case when ltescsinrul = -999 then null else ltescsinrul - 11 end as sinr from mro
"""))
def signal_decoding(spark, sf):
    return d.mro(spark, sf).select(
        "mmeues1apid", "ncellobjectid", codes.rsrp_dbm("ltescrsrp").alias("dbm"),
        codes.rsrq_db("ltescrsrq").alias("rsrq"), codes.sinr_db("ltescsinrul").alias("sinr"))


@query("f10_day_and_hour", """
select event_id, strftime(ts, '%Y%m%d') as day, strftime(ts, '%H') as hour from events
""")
def day_and_hour(spark, sf):
    stamp = F.date_format("ts", "yyyyMMddHH")
    return d.table(spark, sf, "events").select(
        "event_id", codes.hour_day(stamp).alias("day"), codes.hour_hour(stamp).alias("hour"))


# Points: every event placed around the fixture grids, some of them abroad.
POINTS = """
select event_id, 70 + (event_id % 700) / 10.0::double lon, (event_id % 570) / 10.0::double + 0.5 lat,
 70.05 + (event_id % 690) / 10.0::double lon2, (event_id % 560) / 10.0::double + 0.75 lat2,
 cast(event_id % 12 as integer) ta, cast(event_id % 360 as integer) aoa from events
"""
MERC_X = "({lon}) * 20037508.34::double / 180"
MERC_Y = "ln(tan((90 + ({lat})) * pi() / 360)) / (pi() / 180) * 20037508.34::double / 180"
LON_OF = "({x}) / 20037508.34::double * 180"
LAT_OF = "180 / pi() * (2 * atan(exp(({y}) / 20037508.34::double * 180 * pi() / 180)) - pi() / 2)"


def points(spark, sf):
    event = F.col("event_id")
    return d.table(spark, sf, "events").select(
        "event_id",
        (70 + (event % 700) / 10.0).alias("lon"), ((event % 570) / 10.0 + 0.5).alias("lat"),
        (70.05 + (event % 690) / 10.0).alias("lon2"), ((event % 560) / 10.0 + 0.75).alias("lat2"),
        (event % 12).cast("int").alias("ta"), (event % 360).cast("int").alias("aoa"),
    )


def _round(value, name, digits=8):
    return F.round(value, digits).alias(name)


def gcj_sql(lon: str, lat: str) -> tuple[str, str]:
    """Latitude and longitude expressions of the GCJ-02 offset."""
    x, y = f"({lon} - 105)", f"({lat} - 35)"
    common = f"(20 * sin(6 * {x} * pi()) + 20 * sin(2 * {x} * pi())) * 2 / 3"
    d_lat = (f"(-100 + 2 * {x} + 3 * {y} + 0.2::double * {y} * {y} + 0.1::double * {x} * {y} "
             f"+ 0.2::double * sqrt(abs({x})) + {common} "
             f"+ (20 * sin({y} * pi()) + 40 * sin({y} / 3 * pi())) * 2 / 3 "
             f"+ (160 * sin({y} / 12 * pi()) + 320 * sin({y} * pi() / 30)) * 2 / 3)")
    d_lon = (f"(300 + {x} + 2 * {y} + 0.1::double * {x} * {x} + 0.1::double * {x} * {y} "
             f"+ 0.1::double * sqrt(abs({x})) + {common} "
             f"+ (20 * sin({x} * pi()) + 40 * sin({x} / 3 * pi())) * 2 / 3 "
             f"+ (150 * sin({x} / 12 * pi()) + 300 * sin({x} / 30 * pi())) * 2 / 3)")
    ee = "0.00669342162296594323::double"
    magic = f"(1 - {ee} * sin({lat} / 180 * pi()) * sin({lat} / 180 * pi()))"
    inside = f"({lon} between 72.004 and 137.8347 and {lat} between 0.8293 and 55.8271)"
    new_lat = f"{lat} + {d_lat} * 180 / ((6378245.0::double * (1 - {ee})) / ({magic} * sqrt({magic})) * pi())"
    new_lon = f"{lon} + {d_lon} * 180 / (6378245.0::double / sqrt({magic}) * cos({lat} / 180 * pi()) * pi())"
    return f"case when {inside} then {new_lat} else {lat} end", f"case when {inside} then {new_lon} else {lon} end"


_GCJ_LAT, _GCJ_LON = gcj_sql("lon", "lat")


@query("g1_wgs84_to_gcj02", f"""
with points as ({POINTS})
select event_id, round({_GCJ_LAT}, 8) as gcj_lat, round({_GCJ_LON}, 8) as gcj_lon from points
""")
def wgs84_to_gcj02(spark, sf):
    gcj = geo.wgs84_to_gcj02("lat", "lon")
    return points(spark, sf).select("event_id", _round(gcj["lat"], "gcj_lat"), _round(gcj["lon"], "gcj_lon"))


@query("g2_lonlat_to_mercator", f"""
with points as ({POINTS})
select event_id, round({MERC_X.format(lon='lon')}, 5) as x, round({MERC_Y.format(lat='lat')}, 5) as y from points
""")
def lonlat_to_mercator(spark, sf):
    m = geo.lonlat_to_mercator("lon", "lat")
    return points(spark, sf).select("event_id", _round(m["x"], "x", 5), _round(m["y"], "y", 5))


@query("g3_mercator_to_lonlat", f"""
with points as ({POINTS})
select event_id, round({LON_OF.format(x='lon * 100000')}, 8) as lon,
 round({LAT_OF.format(y='lat * 100000')}, 8) as lat from points
""")
def mercator_to_lonlat(spark, sf):
    p = geo.mercator_to_lonlat(F.col("lon") * 100000, F.col("lat") * 100000)
    return points(spark, sf).select("event_id", _round(p["lon"], "lon"), _round(p["lat"], "lat"))


@query("g4_distances", f"""
with points as ({POINTS}), m as (
 select *, {MERC_X.format(lon='lon')} x1, {MERC_X.format(lon='lon2')} x2,
  {MERC_Y.format(lat='lat')} y1, {MERC_Y.format(lat='lat2')} y2 from points)
select event_id, round(sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)), 4) as metres,
 round(sqrt((lon - lon2) * (lon - lon2) + (lat - lat2) * (lat - lat2)), 8) as planar from m
""")
def distances(spark, sf):
    return points(spark, sf).select(
        "event_id", _round(geo.mercator_distance("lat", "lon", "lat2", "lon2"), "metres", 4),
        _round(geo.planar_distance("lon", "lat", "lon2", "lat2"), "planar"))


@query("g5_city_grid_index", f"""
with points as ({POINTS}), m as (
 select event_id, {MERC_X.format(lon='lon')} - {MERC_X.format(lon='70.0::double')} dx,
  {MERC_Y.format(lat='60.0::double')} - {MERC_Y.format(lat='lat')} dy from points)
select event_id, (cast(trunc(dy) as bigint) // 50) * 4000 + (cast(trunc(dx) as bigint) // 50) + 1 as grid_index from m
""")
def city_grid_index(spark, sf):
    return points(spark, sf).select(
        "event_id", geo.city_grid_index("lat", "lon", 60.0, 70.0, 50, 4000).cast("bigint").alias("grid_index"))


def _bd_sql(published: bool) -> tuple[str, ...]:
    w = "3000.0::double * pi() / 180" if published else "pi()"
    z = f"sqrt(lon * lon + lat * lat) + 0.00002::double * sin(lat * {w})"
    theta = f"atan2(lat, lon) + 0.000003::double * cos(lon * {w})"
    x, y = "(lon - 0.0065::double)", "(lat - 0.006::double)"
    back_z = f"(sqrt({x} * {x} + {y} * {y}) - 0.00002::double * sin({y} * {w}))"
    back_theta = f"(atan2({y}, {x}) - 0.000003::double * cos({x} * {w}))"
    return (f"({z}) * cos({theta}) + 0.0065::double", f"({z}) * sin({theta}) + 0.006::double",
            f"{back_z} * sin({back_theta})", f"{back_z} * cos({back_theta})")


def _bd_query(published: bool):
    parts = _bd_sql(published)
    names = ("bd_lon", "bd_lat", "gcj_lat", "gcj_lon")
    columns = ", ".join(f"round({p}, 8) as {n}" for p, n in zip(parts, names))
    sql = f"with points as ({POINTS}) select event_id, {columns} from points"

    @query("g6_bd09_published" if published else "g6_bd09", sql)
    def bd09(spark, sf):
        bd, gcj = geo.gcj02_to_bd09("lon", "lat", published), geo.bd09_to_gcj02("lat", "lon", published)
        return points(spark, sf).select(
            "event_id", _round(bd["lon"], "bd_lon"), _round(bd["lat"], "bd_lat"),
            _round(gcj["lat"], "gcj_lat"), _round(gcj["lon"], "gcj_lon"))

    return bd09


_bd_query(False)
_bd_query(True)

HAVERSINE = """round(2 * asin(sqrt(pow(sin(({lat1} - {lat2}) * pi() / 360), 2)
 + cos({lat1} * pi() / 180) * cos({lat2} * pi() / 180) * pow(sin(({lon1} - {lon2}) * pi() / 360), 2)))
 * 6371.393::double * 1000)"""


@query("g7_haversine", f"""
with points as ({POINTS})
select event_id, {HAVERSINE.format(lon1='lon', lat1='lat', lon2='lon2', lat2='lat2')} as metres from points
""")
def haversine(spark, sf):
    return points(spark, sf).select("event_id", geo.haversine_metres("lon", "lon2", "lat", "lat2").alias("metres"))


GRID_COL = "cast(floor({lon} * pi() / 180 * 6378137.0::double / 5) as bigint)"
GRID_ROW = ("cast(floor(6378137.0::double / 2 * ln((1 + sin({lat} * pi() / 180)) / (1 - sin({lat} * pi() / 180))) / 5)"
            " as bigint)")


@query("g8_grid_of_point", with_tables("mdt", f"""
select time_stamp, mmeues1apid, objectid,
 {GRID_COL.format(lon='longitude')} || '_' || {GRID_ROW.format(lat='latitude')} as gridid from mdt
"""))
def grid_of_point(spark, sf):
    from gridscope_checks.queries_grid import mdt_points

    return mdt_points(spark, sf).select("time_stamp", "mmeues1apid", "objectid",
                                        geo.gridid_of("longitude", "latitude").alias("gridid"))


@query("g9_grid_centre", with_tables("grids", f"""
select distinct google_gci || '_' || google_gri as gridid, round({GRID_LON.format(gci='google_gci')}, 8) as longitude,
 round({GRID_LAT.format(gri='google_gri')}, 8) as latitude from grids
"""))
def grid_centre(spark, sf):
    centre = geo.grid_centre("google_gci", "google_gri")
    return d.finger_raw(spark, sf).select(
        geo.grid_text("google_gci", "google_gri").alias("gridid"),
        _round(centre["lon"], "longitude"), _round(centre["lat"], "latitude")).distinct()


@query("g10_regrid", with_tables("finger", f"""
select gridid, cast(trunc({MERC_X.format(lon='longitude')} / 5 + 0.5) as bigint) || '_'
 || cast(trunc({MERC_Y.format(lat='latitude')} / 5 + 0.5) as bigint) as regrid
from (select distinct gridid, longitude, latitude from finger) f
"""))
def regrid(spark, sf):
    # Half a grid step away from the corner, so that no rounding sits on an edge.
    return d.finger_raw(spark, sf).select(
        geo.grid_text("google_gci", "google_gri").alias("gridid"),
        geo.regrid(F.col("google_gci") + 0.5, F.col("google_gri") + 0.5).alias("regrid")).distinct()


@query("g11_ta_aoa_point", f"""
with points as ({POINTS}), r as (
 select *, 300000.0::double * greatest(ta * 16, 6) / 30720 / 2 reach from points), m as (
 select *, {MERC_X.format(lon='lon')} + reach * cos((aoa + 90) * pi() / 180) x,
  {MERC_Y.format(lat='lat')} + reach * sin((aoa + 90) * pi() / 180) y from r)
select event_id, round({LON_OF.format(x='x')}, 8) as longitude, round({LAT_OF.format(y='y')}, 8) as latitude from m
""")
def ta_aoa_point(spark, sf):
    p = geo.ta_aoa_point("lon", "lat", "ta", "aoa")
    return points(spark, sf).select("event_id", _round(p["lon"], "longitude"), _round(p["lat"], "latitude"))


_SITE_LAT, _SITE_LON = gcj_sql("site_lon", "site_lat")


@query("g12_point_in_cell", f"""
with points as ({POINTS}), s as (
 select event_id, lon, lat, lon + 0.004::double site_lon, lat + 0.002::double site_lat, event_id % 16 rttd from points),
t as (select *, {_SITE_LAT} s_lat, {_SITE_LON} s_lon from s)
select event_id, sqrt(pow({MERC_X.format(lon='lon')} - {MERC_X.format(lon='s_lon')}, 2)
 + pow({MERC_Y.format(lat='lat')} - {MERC_Y.format(lat='s_lat')}, 2)) <= (rttd + 4) * 78.125::double as inside from t
""")
def point_in_cell(spark, sf):
    near = points(spark, sf)
    inside = geo.point_in_cell("lat", "lon", F.col("lat") + 0.002, F.col("lon") + 0.004, F.col("event_id") % 16)
    return near.select("event_id", inside.alias("inside"))


@query("f5_g7_g8_sql_names", f"""
with points as ({POINTS})
select event_id, cast(event_id * 256 + event_id % 7 as integer) as objectid,
 {HAVERSINE.format(lon1='lon', lat1='lat', lon2='lon2', lat2='lat2')} as metres,
 {GRID_COL.format(lon='lon')} as grid_column, {GRID_ROW.format(lat='lat')} as grid_row from points
""")
def names_in_sql(spark, sf):
    sql_names.register(spark)
    points(spark, sf).createOrReplaceTempView("gridscope_points")
    return spark.sql("""
        select event_id, transformObjectId(concat(event_id, '_', event_id % 7)) as objectid,
               st_distance(lon, lon2, lat, lat2) as metres,
               getwebmercatorfromwgs(lon, 'lon') as grid_column, getwebmercatorfromwgs(lat, 'lat') as grid_row
        from gridscope_points""")


def _documents(spark, sf, *columns):
    return d.table(spark, sf, "documents").select("doc_id", *columns)


def _digest(value, name):
    return F.md5(value.cast("binary")).alias(name)


@query("k1_is_empty", """
select doc_id, (text is null or text = '') as empty_text, (lang is null or lang = '') as empty_lang from documents
""")
def is_empty(spark, sf):
    return _documents(spark, sf, text.is_empty("text").alias("empty_text"), text.is_empty("lang").alias("empty_lang"))


@query("k2_join_items", """
select doc_id, md5(array_to_string(list_filter(string_split(text, ' '),
 lambda s: regexp_replace(s, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') <> ''), '|')) as joined from documents
""")
def join_items(spark, sf):
    return _documents(spark, sf, _digest(text.join_items(F.split("text", " "), "|"), "joined"))


@query("k3_equals_any", """
select doc_id, lang in ('en', 'de') as listed, doc_id % 3 = 1 as numbered from documents
""")
def equals_any(spark, sf):
    return _documents(spark, sf, text.equals_any(F.concat(F.lit(" "), "lang"), F.lit("en, d e")).alias("listed"),
                      text.equals_any((F.col("doc_id") % 3).cast("string"), F.lit("1;7"), ";").alias("numbered"))


@query("k4_cut_marked", """
select doc_id, md5(case when length(text) > 200 then text[:200] || '...' else text end) as omitted,
 md5(case when length(text) > 200 then text[:200] || '~' else '' end) as cut from documents
""")
def cut_marked(spark, sf):
    return _documents(spark, sf, _digest(text.omit_after("text", 200), "omitted"),
                      _digest(text.cut_with_symbol("text", 200, "~"), "cut"))


@query("k5_mask_email", """
select c_custkey, repeat('*', length(lower(c_name))) || '@' || lower(c_mktsegment) || '.example' as masked,
 c_name as unmasked from customer
""")
def mask_email(spark, sf):
    email = F.concat(F.lower("c_name"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example"))
    return d.table(spark, sf, "customer").select("c_custkey", text.mask_email(email).alias("masked"),
                                                 text.mask_email("c_name").alias("unmasked"))


@query("k6_repeat", "select c_custkey, repeat(c_mktsegment, 3) as repeated from customer")
def repeat(spark, sf):
    return d.table(spark, sf, "customer").select("c_custkey", text.repeat("c_mktsegment", 3).alias("repeated"))


@query("k7_drop_ends", """
select doc_id, md5(case when length(text) >= 300 then substr(text, 301) else '' end) as without_left,
 md5(case when length(text) > 300 then text[:length(text) - 300] else text end) as without_right from documents
""")
def drop_ends(spark, sf):
    return _documents(spark, sf, _digest(text.drop_left("text", 300), "without_left"),
                      _digest(text.drop_right("text", 300), "without_right"))


@query("k8_split_items", """
select doc_id, len(regexp_split_to_array(text, '[ \\n]+')) as parts,
 md5(regexp_split_to_array(text, '[ \\n]+')[1]) as first_part from documents
""")
def split_items(spark, sf):
    parts = text.split_items("text", "[ \\n]+")
    return _documents(spark, sf, F.size(parts).cast("bigint").alias("parts"), _digest(parts[0], "first_part"))


@query("k9_format_by_pattern", """
select l_orderkey, l_linenumber, l_extendedprice, format('{:.2f}', l_extendedprice) as shown from lineitem
""")
def format_by_pattern(spark, sf):
    return _lines(spark, sf).select("l_orderkey", "l_linenumber", "l_extendedprice",
                                    text.format_by_pattern("l_extendedprice", "#.00").alias("shown"))


@query("k10_left_right", """
select doc_id, md5(left(text, 40)) as head, md5(right(text, 40)) as tail from documents
""")
def left_right(spark, sf):
    return _documents(spark, sf, _digest(text.left("text", 40), "head"), _digest(text.right("text", 40), "tail"))


@query("k11_strip_whitespace", """
select doc_id, md5(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', '', 'g')) as stripped from documents
""")
def strip_whitespace(spark, sf):
    return _documents(spark, sf, _digest(text.strip_whitespace("text"), "stripped"))


@query("k12_strip_punctuation", """
select doc_id, md5(regexp_replace(text, '[\\pP$+<=>^`|~]+', '', 'g')) as stripped from documents
""")
def strip_punctuation(spark, sf):
    return _documents(spark, sf, _digest(text.strip_punctuation("text"), "stripped"))


@query("k13_count_of", """
select doc_id, cast((length(text) - length(replace(text, 'th', ''))) // 2 as integer) as th_count from documents
""")
def count_of(spark, sf):
    return _documents(spark, sf, text.count_of("text", "th").alias("th_count"))


@query("k14_replace", """
select doc_id,
 md5(case when strpos(text, 'on') > 0 then substr(text, 1, strpos(text, 'on') - 1) || 'ON'
  || substr(text, strpos(text, 'on') + 2) else text end) as first_replaced,
 md5(regexp_replace(text, '(?s)^(.*)on', '\\1ON')) as last_replaced,
 md5(replace(text, 'on', '')) as removed from documents
""")
def replace(spark, sf):
    return _documents(spark, sf, _digest(text.replace_first("text", "on", "ON"), "first_replaced"),
                      _digest(text.replace_last("text", "on", "ON"), "last_replaced"),
                      _digest(text.remove_all("text", "on"), "removed"))


@query("k15_first_letter", """
select doc_id,
 md5(case when regexp_matches(text, '^[a-z]') then upper(text[1]) || substr(text, 2) else text end) as upper_text,
 md5(case when regexp_matches(text, '^[A-Z]') then lower(text[1]) || substr(text, 2) else text end) as lower_text
from documents
""")
def first_letter(spark, sf):
    return _documents(spark, sf, _digest(text.upper_first("text"), "upper_text"),
                      _digest(text.lower_first("text"), "lower_text"))


@query("k16_end_equality", """
select p_partkey, left(p_name, 2) = left(p_type, 2) as same_left, right(p_name, 1) = right(p_brand, 1) as same_right
from part
""")
def end_equality(spark, sf):
    return d.table(spark, sf, "part").select("p_partkey", text.left_equal("p_name", "p_type", 2).alias("same_left"),
                                             text.right_equal("p_name", "p_brand", 1).alias("same_right"))
