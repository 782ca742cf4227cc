"""Fingerprint, neighbours, ranking, skew and drive tests against plain readings."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridscope_checks import domain as d
from gridscope.operators import fingerprint, mdt, neighbours, ranking, skew
from gridscope.sources import mdt_text

RAW = "google_gci bigint, google_gri bigint, grid_height int, " + ", ".join(
    f"antenna_{k} string, rsrp_{k} double" for k in range(7))


def raw_row(height, *slots):
    slots = list(slots) + [(None, None)] * (7 - len(slots))
    return (2610882, 776956, height, *[v for slot in slots for v in slot])


def test_slots_without_antenna_or_signal_vanish(table):
    raw = table(RAW, raw_row(0, ("1_2", -70.0), (None, -60.0), ("1_3", None), ("ax_1", -80.0)), raw_row(5))
    rows = fingerprint.antenna_readings(raw)
    assert sorted((r.n_objectid, r.n_rsrp, r.gridid) for r in rows.collect()) == [
        (0, -80.0, "2610882_776956"), (258, -70.0, "2610882_776956")]
    by_union = fingerprint.antenna_readings_by_union(raw)
    assert rows.exceptAll(by_union).isEmpty() and by_union.exceptAll(rows).isEmpty()


def test_fingerprint_serving_cell_per_channel(table):
    row = raw_row(0, ("1_1", -70.0), ("1_2", -60.0), ("2_1", -90.0))
    cells = table("objectid bigint, earfcn int", (257, 100), (258, 100), (258, 100), (513, 200))
    ground, upper = fingerprint.build_fingerprint(table(RAW, row, row, raw_row(5, *[("1_1", -70.0), ("1_2", -60.0)])), cells)
    assert sorted((r.objectid, r.n_objectid, r.rsrp, r.n_rsrp) for r in ground.collect()) == [
        (258, 257, -60.0, -70.0), (258, 513, -60.0, -90.0), (513, 257, -90.0, -70.0), (513, 258, -90.0, -60.0)]
    assert [(r.objectid, r.n_objectid, r.height) for r in upper.collect()] == [(258, 257, 5)]


def test_calibration_takes_measured_signal(table):
    finger = table("objectid bigint, gridid string, longitude double, latitude double, rsrp double, "
                   "n_objectid bigint, n_rsrp double, height int",
                   (1, "a", 1.0, 2.0, -70.0, 2, -80.0, 0), (1, "b", 1.0, 2.0, -70.0, 2, -80.0, 0))
    measured = table("gridid string, longitude double, latitude double, avgrsrp double",
                     ("a", 9.0, 8.0, -65.5), ("b", 9.0, 8.0, 0.0))
    rows = {r.gridid: (r.longitude, r.rsrp) for r in fingerprint.calibrate_fingerprint(finger, measured).collect()}
    assert rows == {"a": (9.0, -65.5), "b": (1.0, -70.0)}


def test_indoor_noise_is_bounded_and_fixed(spark, sf):
    site = d.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("oid"), F.lit(0).alias("sitetype"))
    cells = d.res_cell(spark, sf)
    args = (site, cells, cells.select("objectid", (F.col("objectid") % 30).cast("int").alias("buildingid")),
            d.grid_building(spark, sf), d.finger(spark, sf))
    once, again = fingerprint.indoor_fingerprint(*args), fingerprint.indoor_fingerprint(*args)
    low, high = once.agg(F.min("rsrp"), F.max("rsrp")).first()
    assert -100 <= low < -95 and -85 < high <= -80
    assert once.exceptAll(again).isEmpty()


def metres(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((p - q) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(a[0] - b[0]) / 2) ** 2
    return math.floor(2 * math.asin(min(1.0, math.sqrt(h))) * 6371393 + 0.5)


def random_cells(seed, count=160):
    """Clusters, repeated positions, both sides of the date line, and a channel with a third of all cells."""
    rng = random.Random(seed)
    centres = [(117.2, 32.9), (117.2, 32.9), (179.99, 10.0), (-179.99, 10.0), (0.0, 89.9), (rng.uniform(-180, 180), -40.0)]
    cells = []
    for eci in range(count):
        lon, lat = rng.choice(centres)
        if rng.random() < 0.8:
            lon, lat = lon + rng.gauss(0, 0.01), max(-90.0, min(90.0, lat + rng.gauss(0, 0.01)))
        hot = eci % 3 == 0
        cells.append((eci, lon, lat, 0 if hot else rng.randrange(4), 100 if hot else rng.choice([100, 200])))
    return cells


@pytest.mark.parametrize("seed, per_tile", [(1, 1000), (1, 5), (2, 1), (3, 8)])
def test_nearest_cell_equals_brute_force(table, seed, per_tile):
    rows = random_cells(seed)
    cells = table("eci bigint, longitude double, latitude double, pci int, earfcn int", *rows)
    pairs = cells.select("pci", "earfcn").distinct()
    got = {(r.eci, r.earfcn, r.pci): r.reci
           for r in neighbours.nearest_cell_by_pci(cells, pairs, cells_per_tile=per_tile).collect()}
    expected = {}
    for eci, lon, lat, _, _ in rows:
        for pci, earfcn in {(r[3], r[4]) for r in rows}:
            others = [(metres((lon, lat), (r[1], r[2])), r[0]) for r in rows
                      if (r[3], r[4]) == (pci, earfcn) and r[0] != eci]
            if others:
                expected[eci, earfcn, pci] = min(others)[1]
    assert got == expected


def test_channels_without_a_target_are_not_expanded(table, monkeypatch):
    cells = table("eci bigint, longitude double, latitude double, pci int, earfcn int",
                  (1, 117.0, 32.0, 1, 100), (2, 117.1, 32.0, 1, 100), (3, 117.2, 32.0, 2, 100))
    pairs = table("pci int, earfcn int", *[(p, 100) for p in range(1, 50)], (None, 100))
    met = []
    whole = neighbours.expand_channels
    monkeypatch.setattr(neighbours, "expand_channels", lambda *a: met.append(whole(*a)) or met[-1])
    got = sorted((r.eci, r.pci, r.reci) for r in neighbours.nearest_cell_by_pci(cells, pairs).collect())
    assert got == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 2)]
    assert met[0].count() == 6  # three cells, two channels that cells have


def test_expanding_is_whole(table):
    cells = table("eci bigint, longitude double, latitude double", *[(i, 1.0, 2.0) for i in range(7)])
    pairs = table("pci int, earfcn int", *[(p, e) for p in range(20) for e in (100, 200)], (0, 100))
    rows = neighbours.expand_channels(cells, pairs)
    assert rows.count() == rows.distinct().count() == 7 * 40
    assert "NestedLoop" not in rows._jdf.queryExecution().executedPlan().toString()


def test_resolving_modes(table):
    fields = ["eci bigint", "mmeues1apid string", "timestamp string", "ltescrsrp int", "ltescrsrq int",
              "ltescsinrul double", "ltescearfcn int", "ltescpci int", "ltesctadv int", "ltescaoa int",
              "ltescpuschprbnum int", "ltescpdschprbnum int", "ltescplrulqci1 double", "ltescplrdlqci1 double"]
    values = [5, "u", "t", 50, 1, 1.0, 100, 1, 0, 0, 1, 1, 0.0, 0.0]
    for i in range(1, 9):
        fields += [f"ltencrsrp_{i} int", f"ltencearfcn_{i} int", f"ltencpci_{i} int"]
        values += [40 + i if i < 3 else None, 200, i]
    wide = table(", ".join(fields), tuple(values))
    nearest = table("eci bigint, earfcn int, pci int, reci bigint", (5, 100, 1, 70), (5, 200, 1, 71), (5, 200, 3, 73))
    serving = neighbours.resolve_neighbours(wide, nearest)
    paired = neighbours.resolve_neighbours(wide, nearest, "paired")
    assert sorted((r.ncellobjectid, r.ltencrsrp) for r in serving.collect()) == [(70, 41), (70, 42)]
    assert [(r.ncellobjectid, r.ltencrsrp) for r in paired.collect()] == [(71, 41)]
    assert set(serving.columns) == set(paired.columns)
    with pytest.raises(ValueError):
        neighbours.resolve_neighbours(wide, nearest, "other")


def test_global_row_number_with_a_hot_key(table):
    rows = [(5 if i % 3 == 0 else i % 17 - 8, i) for i in range(400)]
    ranked = ranking.global_row_number(table("k bigint, v int", *rows), "k", ranges=5).collect()
    assert sorted(r.row_number for r in ranked) == list(range(1, 401))
    by_rank = [r.k for r in sorted(ranked, key=lambda r: r.row_number)]
    assert by_rank == sorted(k for k, _ in rows)


def test_global_row_number_spreads_a_hot_key_and_takes_nulls_and_repeats(table, spark):
    rows = [(1, i // 2) for i in range(600)] + [(None, i) for i in range(5)] + [(2, None), (0, None), (0, None)]
    ranked = ranking.global_row_number(table("k bigint, v int", *rows), "k", ranges=6)
    got = sorted(ranked.collect(), key=lambda r: r.row_number)
    assert [r.row_number for r in got] == list(range(1, len(rows) + 1))
    assert [r.k for r in got] == [None] * 5 + [0, 0] + [1] * 600 + [2]
    assert sorted(map(str, ((r.k, r.v) for r in got))) == sorted(map(str, rows))
    assert ranking.global_row_number(table("k bigint, v int"), "k").count() == 0


def test_heavy_cells(table):
    counts = table("objectid bigint, objectcount bigint", *[(i, 2) for i in range(20)], (100, 30), (101, 30), (102, 12), (103, 10))
    heavy = {r.objectid for r in skew.skew_report(counts).where("heavy").collect()}
    assert heavy == {100, 101, 102}
    keys = table("objectid bigint", (1,))
    rows = table("objectid bigint, v int", (1, 1), (2, 2), (None, 3))
    assert [r.v for r in skew.rows_in(rows, keys).collect()] == [1]
    assert [r.v for r in skew.rows_not_in(rows, keys).collect()] == [2]


def test_mdt_text_is_read_tolerantly(table):
    lines = table("value string",
                  ("t1,,,,,,u1,12,-70,,117.5,,32.5,x",), (",,,,,,,bad,bad,,117.5,,32.5",),
                  ("t3,,,,,,u3,12,-70,,120.0,,32.5",), ("t4,,,,,,u4",), ("t5,,,,,,u5,1,2,,abc,,32.5",))
    rows = mdt_text.parse_mdt(lines, 1).collect()
    assert [tuple(r) for r in rows] == [("t1", "u1", 12, -70, 117.5, 32.5, 0), (None, None, 0, 0, 117.5, 32.5, 0)]
    second = table("value string", ("t,,,,,,u,12,9,300,-71,,118.0,,31.0",))
    assert [tuple(r) for r in mdt_text.parse_mdt(second, 2).collect()] == [("t", "u", 12, -71, 118.0, 31.0, 0)]


def test_mdt_points_with_missing_keys_do_not_count(table):
    located = table("objectid bigint, time_stamp string, mmeues1apid string, ltescrsrp int, gridid string, "
                    "longitude double, latitude double", (1, "t", "u", -70, "g", 1.0, 2.0), (1, None, "u", -80, "g", 1.0, 2.0))
    ground = table("gridid string, longitude double, latitude double", ("g", 1.0, 2.0), ("h", 3.0, 4.0), ("h", 3.0, 4.0))
    rows = {r.gridid: (r.avgrsrp, r.mdtpoint) for r in mdt.mdt_grid_stats(located, ground).collect()}
    assert rows == {"g": (-75.0, 1), "h": (0.0, 0)}


def test_slots_follow_the_columns(table, spark):
    wide = spark.sql("""select 1L eci, -70 ltencrsrp_1, cast(null as int) ltencrsrp_2, -71 ltencrsrp_9, -72 ltencrsrp_12,
                        5 ltencearfcn_1, 6 ltencearfcn_9, 7 ltencpci_1, 8 ltencpci_9""")
    rows = neighbours.unpivot_neighbours(wide.select("eci", "ltencrsrp_1", "ltencrsrp_2", "ltencrsrp_9", "ltencrsrp_12"))
    assert rows.columns == ["eci", "ltencrsrp"] and sorted(r.ltencrsrp for r in rows.collect()) == [-72, -71, -70]
    cells = spark.sql("select 1L eci, 117.0D longitude, 32.0D latitude")
    asked = neighbours.reported_channels(wide, cells, "paired")
    assert {(r.earfcn, r.pci) for r in asked.collect()} == {(5, 7), (6, 8), (None, None)}
    raw = spark.sql("""select 100L google_gci, 200L google_gri, 0 grid_height, '1_1' antenna_0, -60D rsrp_0,
                       '1_2' antenna_9, -61D rsrp_9""")
    assert {r.n_objectid for r in fingerprint.antenna_readings(raw).collect()} == {257, 258}
    assert fingerprint.antenna_readings_by_union(raw).count() == 2
