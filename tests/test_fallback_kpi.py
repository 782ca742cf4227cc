"""Fallback and report tables on small rows."""

import pytest
from pyspark.sql import functions as F

from gridscope_checks import domain as d
from gridscope.functions.geo import grid_centre
from gridscope.operators import fallback, kpi
from gridscope.operators.locate import locate
from gridscope.sources.tables import cut_lineage

LOCATED = "gridid string, objectid bigint, height int, ltescrsrp int, ltescrsrq int, ltescsinrul double"


def test_located_and_unlocated_make_up_all_samples(spark, sf):
    mro = d.mro(spark, sf)
    located = cut_lineage(locate(mro, d.finger(spark, sf)))
    samples = fallback.serving_rows(mro)
    rest = fallback.unlocated(samples, located)
    assert samples.count() == located.count() + rest.count()
    keys = ["objectid", "mmeues1apid", "time_stamp"]
    assert located.select(*keys).intersect(rest.select(*keys)).isEmpty()
    assert samples.select(*keys).distinct().count() == samples.count()


def test_serving_row_is_the_strongest(table):
    schema = "objectid bigint, mmeues1apid string, time_stamp string, ltescrsrp int, ltescrsrq int, " \
             "ltescsinrul double, ta int, aoa int"
    rows = [(1, "u", "t", 40, 1, 1.0, 1, 1), (1, "u", "t", 50, 2, 2.0, 2, 2), (1, "u", "t", None, 3, 3.0, 3, 3)]
    assert [tuple(r) for r in fallback.serving_rows(table(schema, *rows)).collect()] == [rows[1]]


def test_fallback_snaps_to_the_grid_of_the_site(table, spark):
    centre = spark.range(1).select(grid_centre(F.lit(2610010), F.lit(776010)).alias("c")).first().c
    shifted = spark.range(1).select(grid_centre(F.lit(2610010), F.lit(776010 + 5.859375)).alias("c")).first().c
    samples = table("objectid bigint, mmeues1apid string, time_stamp string, ltescrsrp int, ltescrsrq int, "
                    "ltescsinrul double, ta int, aoa int",
                    (1, "near", "t", 40, 1, 1.0, 0, 0), (1, "far", "t", 40, 1, 1.0, 500, 0), (2, "no site", "t", 1, 1, 1.0, 0, 0))
    sites = table("objectid bigint, longitude double, latitude double", (1, centre.lon, centre.lat))
    ground = table("gridid string, longitude double, latitude double, height int",
                   ("b", shifted.lon, shifted.lat, 0), ("a", shifted.lon, shifted.lat, 0))
    placed = fallback.locate_by_ta_aoa(samples, sites, ground).collect()
    assert [(r.mmeues1apid, r.gridid, r.height) for r in placed] == [("near", "a", 0)]


def test_jitter_is_fixed_per_sample(table):
    samples = table("objectid bigint, mmeues1apid string, time_stamp string", *[(1, f"u{i}", "t") for i in range(200)])
    once, again = (samples.select("*", fallback.hashed_jitter().alias("j")) for _ in range(2))
    assert once.exceptAll(again).isEmpty()
    assert {r.j for r in once.select("j").distinct().collect()} == set(range(15))


def test_bins_and_missing_marks(table):
    codes = [(0, -999, -999.0), (1, 10, 7.0), (30, 20, 8.0), (31, -999, 10.0), (41, 30, 11.0), (51, 31, 21.0), (61, 32, 26.0)]
    row = kpi.grid_measures(table(LOCATED, *[("g", 1, 0, *c) for c in codes])).first()
    assert (row.mrpointnum, row.weakpointnum) == (7, 4)
    rsrp = (row.rsrp_140_110_count, row.rsrp_110_100_count, row.rsrp_100_90_count, row.rsrp_90_80_count, row.rsrp_80_count)
    sinr = (row.sinrul_3_count, row.sinrul_3_0_count, row.sinrul_0_10_count, row.sinrul_10_15_count, row.sinrul_15_count)
    assert rsrp == (2, 1, 1, 1, 1) and sinr == (1, 2, 1, 1, 1)
    assert row.avgrsrq == pytest.approx((-15 - 10 - 5 - 4.5 - 4) / 5)
    assert row.avgsinrul == pytest.approx((-4 - 3 - 1 + 0 + 10 + 15) / 6)


def test_grid_without_valid_readings_has_no_mean(table):
    row = kpi.grid_measures(table(LOCATED, ("g", 1, 0, 50, -999, -999.0))).first()
    assert row.avgrsrq is None and row.avgsinrul is None


def test_overlap_needs_three_co_strength_rows(table):
    schema = "objectid bigint, mmeues1apid string, time_stamp string, ltescrsrp int, ltencrsrp int"
    rows = [(1, "a", "t", 50, n) for n in (44, 56, 50, 60)] + [(1, "b", "t", 50, n) for n in (50, 50, 57)]
    located = table("objectid bigint, mmeues1apid string, time_stamp string, gridid string",
                    (1, "a", "t", "g"), (1, "b", "t", "g"), (1, "c", "t", "h"))
    counts = {r.gridid: r.overlapd for r in kpi.overlap_by_grid(located, table(schema, *rows)).collect()}
    assert counts == {"g": 1, "h": 0}


def test_facts_of_samples_give_overlap_and_loss(spark, sf):
    mro = d.mro(spark, sf)
    repeated = mro.unionByName(mro.limit(200))
    located = mro.select("objectid", "mmeues1apid", "time_stamp").distinct() \
        .withColumn("gridid", F.concat(F.lit("g"), F.pmod(F.xxhash64("mmeues1apid"), F.lit(40))))
    facts = kpi.sample_facts(located, repeated)
    for got, want in ((kpi.overlap_of(facts), kpi.overlap_by_grid(located, repeated)), (kpi.loss_of(facts), kpi.packet_loss(located, repeated)),
                      (facts.where("reported").drop("reported", "overlap"), kpi.sample_loss(located, repeated))):
        want = want.select(*got.columns)
        assert got.count() > 10 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    lone = located.limit(1).withColumn("mmeues1apid", F.lit("unknown"))
    row, = kpi.sample_facts(lone, repeated).collect()
    assert not row.reported and row.overlap is False


def test_reports_are_exchanged_once(spark, sf, tmp_path):
    d.mro(spark, sf).write.parquet(str(tmp_path / "mro"))
    mro = spark.read.parquet(str(tmp_path / "mro"))
    located = spark.createDataFrame([(1, "a", "t", "g")], "objectid bigint, mmeues1apid string, time_stamp string, gridid string")
    plan = kpi.sample_facts(located, mro)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_empty_grids_fill_ground_only(table):
    located = table(LOCATED, ("g", 1, 0, 50, 1, 1.0), ("h", 1, 5, 50, 1, 1.0))
    ground = table("gridid string, objectid bigint, rsrp double", ("g", 1, -70.0), ("h", 2, -71.0), ("h", 2, -71.0))
    overlaps = table("gridid string, overlapd int", ("g", 4))
    rows = {(r.gridid, r.height): r for r in kpi.grid_kpi(located, overlaps, ground).collect()}
    assert set(rows) == {("g", 0), ("h", 5), ("h", 0)}
    assert rows["g", 0].overlapd == 4 and rows["h", 5].overlapd == 0
    assert (rows["h", 0].mrpointnum, rows["h", 0].avgrsrp, rows["h", 0].avgrsrq) == (0, -71.0, -999.0)


def test_loss(table):
    samples = table("gridid string, ta int, ulqci1 double, dlqci1 double, ltescpuschprbnum int, ltescpdschprbnum int",
                    ("g", 1, 10.0, None, 3, -1), ("g", 1, -1.0, 5.0, None, 4), ("g", 1, 20.0, 6.0, 1, 1),
                    ("g", 1, None, -5.0, 1, 1), ("h", 2, None, None, None, None))
    rows = {r.gridid: r for r in kpi.grid_loss(samples).collect()}
    g, h = rows["g"], rows["h"]
    assert (g.udtotal, g.uptotal, g.dltotal) == (3, 2, 2)
    assert (float(g.uplost), float(g.dllost), g.pusum, g.pdsum) == (15.0, 5.5, 5, 6)
    assert (h.udtotal, h.uplost, h.pusum) == (0, None, 0)


def test_loss_bands_share_edges_and_survive_empty_grids(table):
    measures = table("gridid string, mrpointnum bigint", ("g", 3), ("g", 4), ("e", 0))
    loss = table("gridid string, ta int, udtotal bigint, uptotal bigint, uplost decimal(18,4), "
                 "dllost decimal(18,4), pusum bigint, pdsum bigint")
    assert loss.isEmpty()
    spark = measures.sparkSession
    loss = spark.sql("""select * from values
        ('g', 1, 1L, 1L, 10.0BD, 200.0BD, 0L, 0L), ('g', 3, 1L, 1L, 10.0BD, 200.0BD, 0L, 0L)
        as t(gridid, ta, udtotal, uptotal, uplost, dllost, pusum, pdsum)""")
    rows = {r.gridid: r for r in kpi.loss_bands(measures, loss).collect()}
    g = rows["g"]
    assert (g.ulqci1, g.ulqci20, g.ulqci80, g.dlqci1, g.dlqci20, g.dlqci80) == (14, 14, 0, 0, 14, 14)
    assert g.averageta == 2.0 and rows["e"].averageta is None
