"""Request and answer rules on single examples."""

import pytest

from gridscope.operators import features, weblocation as web

URIS = {
    "http://a/q?s_x=30.1&s_y=120.1": [("30.1", "120.1")],
    "http://a/p?from_lat=%28null%29&from_lng=%28null%29&lat=30&lng=120": [("%28null%29", "%28null%29")],
    "http://a/p?lng=1&lng=2&lat=3&lat=4": [("3", "2")],
    "http://a/p?lat=1&lat=2&lng=3": [("2", "3")],
    "http://a/p?LNG=120.5&Lat=30.5": [("30.5", "120.5")],
    "http://a/p?lng=120.5": [],
    "http://a/p?v=lng%22%3a%22120%22%2c%22lat%22%3a%2230": [("30", "120")],
    "http://a/p?m=30,120,7": [("30", "120")],
    "http://a/p?tm=30,120": [],
    "http://a/p?center=30,120": [("30", "120")],
    "http://a/p?center=30,120,": [("30", "120")],
    "http://a/p?center=30,120,1": [],
    "http://a/p?center=30,120(5": [("30", "120")],
    "http://a/p?gps=120,30": [("30", "120")],
    "http://restapi.amap.com/?location=120,30": [("30", "120")],
    "http://a/?location=30,120": [("30", "120")],
    "http://a/p?u=coords:30_120,coords:31_121,coords:a_b": [("30", "120"), ("31", "121")],
    "http://a/p?click=120%2c30%": [("30", "120")],
    "http://a/p?click=120%2cnorth": [],
    "http://a/JW:120|30": [("30", "120")],
    "http://ps.map.baidu.com/?sessid=30,120_31,121|1,2,3&x": [("30", "120"), ("31", "121")],
    "http://a/?sessid=30,120": [],
    "http://a/shop-lat30.5-lng120.5-x": [("30.5", "120.5")],
    "http://a/nothing": [],
    "": [],
    # every further rule once, numbers as the rule gives them: (latitude, longitude)
    "http://b/1?x=120.01&y=30.01": [("30.01", "120.01")],
    "http://b/2?u=lng%3d120.02&v=lat%3d30.02": [("30.02", "120.02")],
    "http://b/3?u=lng%3A120.03&v=lat%3A30.03": [("30.03", "120.03")],
    "http://b/4?lon=120.04&lat=30.04": [("30.04", "120.04")],
    "http://b/5?u=lon%3D120.05&v=lat%3D30.05": [("30.05", "120.05")],
    "http://b/6?don=120.06&lat=30.06": [("30.06", "120.06")],
    "http://b/7?lgt=120.07&lat=30.07": [("30.07", "120.07")],
    "http://b/8?v=longitude%22%3a%22120.08%22%2c%22latitude%22%3a%2230.08": [("30.08", "120.08")],
    "http://b/9?longitude=120.09&latitude=30.09": [("30.09", "120.09")],
    "http://b/10?long=120.10&lat=30.10": [("30.10", "120.10")],
    "http://b/11?MyPosx=120.11&MyPosy=30.11": [("30.11", "120.11")],
    "http://b/12?pointx=120.12&pointy=30.12": [("30.12", "120.12")],
    "http://b/13?a=lou%22%20:%20%22120.13&b=lau%22%20:%20%2230.13": [("30.13", "120.13")],
    "http://b/14?logi=120.14&lati=30.14": [("30.14", "120.14")],
    "http://b/15?v=xy%22%3A%2230.15,120.15": [("30.15", "120.15")],
    "http://b/16?action_gps=30.16,120.16": [("30.16", "120.16")],
    "http://b/17?cur_pt=30.17,120.17": [("30.17", "120.17")],
    "http://b/18?cll=30.18,120.18": [("30.18", "120.18")],
    "http://b/19?geoinfo=30.19,120.19": [("30.19", "120.19")],
    "http://b/20?loc=30.20,120.20": [("30.20", "120.20")],
    "http://b/21?latlng=30.21,120.21": [("30.21", "120.21")],
    "http://b/22?mypos=30.22,120.22": [("30.22", "120.22")],
    "http://b/23?origin=30.23,120.23": [("30.23", "120.23")],
    "http://b/24?points=30.24,120.24": [("30.24", "120.24")],
    "http://b/25?point=30.25,120.25": [("30.25", "120.25")],
    "http://b/26?position=30.26,120.26": [("30.26", "120.26")],
    "http://b/27?q=30.27,120.27": [("30.27", "120.27")],
    "http://b/28?xyr=30.28,120.28": [("30.28", "120.28")],
    "http://b/29?u=coords%3D30.29_120.29,coords%3D31.29_121.29": [("30.29", "120.29"), ("31.29", "121.29")],
    "http://b/30?start=120.30,30.30": [("30.30", "120.30")],
    "http://b/31/JW%3A120.31_30.31,JW%3Abad_30": [("30.31", "120.31")],
    "http://b/32?v=lt%22%3A%22120.32%22%2c%22ltt%22%3A%2230.32": [("30.32", "120.32")],
    "http://b/33?lo=120.33&la=30.33": [("30.33", "120.33")],
    "http://b/34?d=120.34&l=30.34": [("30.34", "120.34")],
    "http://b/35?l=120.35&x=30.35": [("30.35", "120.35")],
    "http://b/36?px=120.36&py=30.36": [("30.36", "120.36")],
}


def test_requests(spark):
    logs = spark.createDataFrame([(u,) for u in URIS] + [(None,)], "uri string")
    got = {r.uri: [tuple(p) for p in r.points or []] for r in web.with_uri_points(logs).collect()}
    wrong = {u: (got[u], want) for u, want in URIS.items() if got[u] != want}
    assert not wrong and got[None] == []


def test_key_pattern_finds_every_key_also_where_keys_overlap():
    import re

    keys = web._looked_up(web.URI_RULES)
    found = re.compile(f"(?=({web.key_pattern(keys)}))")
    text = "s_x=lng%3d=latlng=mypos=pointx=llgt=lo=%22%20:%20%22lou%22%20:%20%22" + "".join(keys)
    assert {k for k in found.findall(text)} == {k for k in keys if k in text}
    with pytest.raises(ValueError):
        web.key_pattern(["lo", "lon"])


def test_strict_keys_start_an_item(spark):
    logs = spark.createDataFrame([("http://a/p?from_lat=1&from_lng=2&lat=30&lng=120",), ("http://a/p?max=1&day=2",)], "uri string")
    points = {r.uri[11:16]: r.points and tuple(r.points[0]) for r in web.with_uri_points(logs, strict=True).collect()}
    assert points == {"from_": ("30", "120"), "max=1": None}
    assert web.with_uri_points(logs).where("points is null").isEmpty()


def test_first_point_and_all_points(spark):
    logs = spark.createDataFrame([(1, "http://a/p?u=coords:30_120,coords:31_121"), (2, "http://a/")], "id int, uri string")
    assert [(r.id, r.latitude, r.longitude) for r in web.uri_locations(logs).orderBy("id").collect()] == [
        (1, "30", "120"), (2, None, None)]
    assert [(r.id, r.position, r.latitude) for r in web.uri_location_rows(logs).orderBy("position").collect()] == [
        (1, 0, "30"), (1, 1, "31")]


ANSWERS = [
    ("apilocate.amap.com", "<cenx>120</cenx><ceny>30</ceny><radius>25</radius>", ("BD", "120", "30", "25", None)),
    (" M5.AMAP.com", '{"x": "120", "y": "30"}', ("GCJ02", "120", "30", None, None)),
    ("m5.amap.com", "<cenx>120</cenx>", None),
    ("api.map.baidu.com", '{"location":{"lng":120,"lat":30},"confidence":9,"p":{"lng":1,"lat":2}}', ("BD", "120", "30", "9", None)),
    ("api.map.baidu.com", '{"lng":120,"lat":30}', None),
    ("rd.go.10086.cn", '{"point":{"x":"120","y":"30"},"radius":"6","clf":"1","ll":"2"}', ("BD", "120", "30", "6", "ll")),
    ("restapi.amap.com", '{"origin":"120,30","to":"1,2"}', ("GCJ02", "120", "30", None, None)),
    ("trafficapp.autonavi.com:8888", "<lon>120</lon><lat>30</lat>", ("GCJ02", "120", "30", None, None)),
    ("other", "<cenx>120</cenx><ceny>30</ceny>", None),
    (None, "<cenx>120</cenx><ceny>30</ceny>", None), ("m5.amap.com", None, None),
]


@pytest.mark.parametrize("at", range(len(ANSWERS)))
def test_answers(spark, at):
    host, content, expected = ANSWERS[at]
    row = web.content_locations(spark.createDataFrame([(host, content)], "host string, content string")).first()
    got = (row.coord_type, row.longitude, row.latitude, row.radius, row.position_type)
    assert row.success == (expected is not None)
    assert got == (expected or (None,) * 5)


def test_answer_comes_before_request(spark):
    logs = spark.createDataFrame([
        ("other", "http://a/?lng=1&lat=2", "x"),
        ("apilocate.amap.com", "http://a/?lng=1&lat=2", "<cenx>120</cenx><ceny>30</ceny>"),
        ("other", "http://a/", None)], "host string, uri string, content string")
    rows = [(r.success, r.longitude, r.coord_type) for r in web.extract_locations(logs).collect()]
    assert rows == [(True, "1", None), (True, "120", "BD"), (False, None, None)]


def test_feature_lines(spark):
    line = "uid 7|age 3 9|LBS 11|interest1 5 6 7|kw2 1|house 1|gender"
    wide = features.user_features_wide(spark.createDataFrame([(line,), ("",)], "value string"))
    assert len(wide.columns) == 232 + 11  # each list feature has a column for the rest
    first, empty = wide.collect()
    assert (first.uid, first.age, first.lbs, first.gender, first.carrier, first.house) == ("7", "3", "11", "0", "0", "1")
    assert [first[f"interest1_{i}"] for i in (1, 2, 3, 4, 20)] == ["5", "6", "7", None, None]
    assert (first.kw2_1, first.kw2_2, first.kw1_1, first.topic3_1, first.topic3_2) == ("1", None, "0", "0", None)
    assert (empty.uid, empty.kw1_1, empty.kw1_2) == ("0", "0", None)


def test_no_feature_value_is_lost(spark):
    values = [str(i) for i in range(30)]
    lines = spark.createDataFrame([("uid u1|kw1 " + " ".join(values) + "|age 3 4",)], "value string")
    wide = features.user_features_wide(lines, slots=4).first()
    assert [wide.kw1_1, wide.kw1_4, wide.kw1_rest] == ["0", "3", values[4:]]
    long = features.feature_values(lines).orderBy("item", "position").collect()
    assert [r.value for r in long if r.feature == "kw1"] == values
    assert [r.value for r in long if r.feature == "age"] == ["3", "4"] and {r.uid for r in long} == {"u1"}
