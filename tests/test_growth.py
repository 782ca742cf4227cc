"""Steps whose cost must not grow faster than their input."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridscope import schemas
from gridscope.operators import locate as L
from gridscope.operators import fingerprint, skew
from test_locate import MRO, _field, make_data


def test_copies_of_a_side_stay_within_both_sides(spark):
    """Small blocks asked for on both sides: the copies that are dealt out are bounded by the sides themselves."""
    readings = spark.range(3000).select(F.lit(1).cast("long").alias("objectid"))
    grids = spark.range(900).select(F.lit(1).cast("long").alias("objectid"))
    row = L.block_counts(readings, grids, 7, 5).first()
    assert row.sample_blocks > 1 and row.finger_blocks > 1
    assert 3000 * row.finger_blocks <= 3000 + 3900 and 900 * row.sample_blocks <= 900 + 3900


def test_a_side_is_cut_where_it_grows_too_large(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_ROWS_PER_BLOCK", 100)
    readings = spark.range(3000).select(F.lit(1).cast("long").alias("objectid"))
    grids = spark.range(900).select(F.lit(1).cast("long").alias("objectid"))
    assert tuple(L.block_counts(readings, grids, 7, 5).first()) == (1, 30, 9)


@pytest.mark.parametrize("alike", [1, 8])
def test_scored_grids_grow_slower_than_the_grids(spark, alike):
    """Four times the grids of a field, or the same grids again, are not four times the work."""
    mro, finger = _field(spark, 13)
    if alike > 1:
        finger = finger.crossJoin(spark.range(alike).withColumnRenamed("id", "again")) \
            .withColumn("gridid", F.concat("gridid", F.lit("_"), "again")).drop("again")
    row = L.scoring_shares(mro, finger).first()
    assert row.pairs == 150 * 1600 * alike and 0 < row.scored < 150 * 1600 / 3


def test_levels_of_nodes_bound_every_grid_below():
    draw = random.Random(3)
    rows = [(g, k, 1.0 + draw.randrange(2), draw.randrange(-40, 40)) for g in range(700) for k in range(6) if draw.random() < 0.9]
    owner, neighbour = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    n, gap = np.array([r[2] for r in rows]), np.array([float(r[3]) for r in rows])
    tiles = L._Tiles([owner, n, gap * n, gap * gap * n], neighbour, 700, 6, 4)
    assert tiles.levels > 2 and tiles.size(0) <= L.TILES_PER_NODE and sorted(np.concatenate(tiles.grids)) == list(range(700))
    r = [np.array([0, 0, 0, 1, 1]), np.ones(5), np.array([3.0, -7, 20, 1, 1]), np.array([9.0, 49, 400, 1, 1])]
    r_nb, starts = np.array([0, 2, 3, 1, 5]), np.array([0, 3, 5])
    for sample in (0, 1):
        own, node = np.array([sample] * tiles.size(0)), np.arange(tiles.size(0))
        above = np.full(len(node), -np.inf)
        for level in range(tiles.levels):
            if level:
                up = node
                own, node = tiles.children(level, own, up)
                assert list(node) == list(range(tiles.size(level)))
                above = bound[node // L.TILES_PER_NODE]
            bound = tiles.bounds(level, node, r, r_nb, starts, own, 1, rows_at_once=5)
            assert (bound >= above).all()


def test_heavy_cells_are_no_shuffle_of_the_reports(table):
    """A cell with most of the rows must not travel to one task because rows are split by a list of cells."""
    mro = table(MRO, *[(0, f"u{i}", "t", 50, 1, 1.0, i % 3, 40) for i in range(60)], (1, "v", "t", 50, 1, 1.0, 0, 40))
    finger = table(schemas.FINGER, *[(c, "g", 0.0, 0.0, -70.0, n, -80.0, 0) for c in (0, 1) for n in range(3)])
    heavy = skew.heavy_cells(mro, finger)
    assert [r.objectid for r in heavy.collect()] == [0]
    for split in (skew.rows_in, skew.rows_not_in):
        plan = split(mro, heavy)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def _pairs_data(table):
    mro_rows, finger_rows = make_data(21)
    return mro_rows, finger_rows, table(MRO, *mro_rows), table(schemas.FINGER, *finger_rows)


def test_pairs_per_cell_add_up_and_are_folded_before_they_meet(table):
    mro_rows, finger_rows, mro, finger = _pairs_data(table)
    want = {}
    for cell, _, _, rsrp, _, _, neighbour, heard in mro_rows:
        for f_cell, gridid, _, _, f_rsrp, f_neighbour, f_heard, height in finger_rows:
            if heard is not None and (cell, neighbour) == (f_cell, f_neighbour):
                n, total = want.get((cell, gridid, height), (0, 0.0))
                want[cell, gridid, height] = n + 1, total + rsrp - heard - (f_rsrp - f_heard)
    found = L.candidate_pairs(mro, finger, per="cell")
    assert found.count() <= finger.select("objectid", "n_objectid", "gridid", "height").distinct().count()
    got = {tuple(r[:3]): tuple(r[3:]) for r in found.groupBy("objectid", "gridid", "height")
           .agg(F.sum("pairs"), F.round(F.sum("gap_sum"), 6)).collect()}
    assert got == {key: (n, round(total, 6)) for key, (n, total) in want.items()}


@pytest.mark.parametrize("options", [{}, {"min_matches": 3, "max_distance": 60.0}, {"min_matches": 1}])
def test_distances_of_pairs_per_sample_equal_those_per_reading(table, monkeypatch, options):
    monkeypatch.setattr(L, "PAIRS_PER_PART", 50)
    monkeypatch.setattr(L, "GRIDS_PER_TILE", 3)
    _, _, mro, finger = _pairs_data(table)
    columns = ["objectid", "mmeues1apid", "time_stamp", "ltescrsrq", "gridid", "height", "distance"]
    by_sample = L.grid_distances(L.candidate_pairs(mro, finger, per="sample"), **options).select(*columns)
    by_reading = L.grid_distances(L.candidate_pairs(mro, finger), **options).select(*columns)
    got, want = (sorted(map(str, map(tuple, df.collect()))) for df in (by_sample, by_reading))
    assert got == want and len(want) > 20
    # nothing is brought together by sample after the sides have met
    plan = by_sample._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan[:plan.index("SortMergeJoin")]


@pytest.mark.parametrize("step", ["pairs", "strongest", "cell pairs"])
def test_a_fingerprint_is_not_sent_whole_to_every_task(table, step):
    """Spark guesses the size of exploded rows from the narrow table they come from."""
    _, _, mro, finger = _pairs_data(table)
    readings = finger.select("gridid", "longitude", "latitude", "height", "n_objectid", "n_rsrp")
    cells = table("objectid bigint, earfcn int", (1, 100), (2, 100))
    df = {"pairs": lambda: L.candidate_pairs(mro, finger), "strongest": lambda: fingerprint.strongest_cells(readings, cells),
          "cell pairs": lambda: fingerprint.cell_pairs(finger.select("objectid", "gridid", "longitude", "latitude", "rsrp", "height"), readings)}[step]()
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_indoor_cells_and_grids_of_several_buildings_meet_once(table):
    sites = table("oid bigint, sitetype int", (1, 0), (2, 1))
    cells = table("siteoid bigint, objectid bigint", (1, 10), (1, 11), (2, 12))
    covers = table("objectid bigint, buildingid int", (10, 5), (10, 6), (10, None), (11, 6), (12, 5), (10, 5))
    stands = table("gridid string, buildingid int", ("a", 5), ("a", 6), ("b", 6), ("b", 6), ("c", 7), ("d", None), (None, 5))
    serving = table("gridid string, longitude double, latitude double, height int",
                    ("a", 1.0, 2.0, 0), ("a", 1.0, 2.0, 0), ("a", 1.0, 2.0, 5), ("b", None, 2.0, 0), ("c", 1.0, 2.0, 0), ("d", 1.0, 2.0, 0))
    df = fingerprint.indoor_fingerprint(sites, cells, covers, stands, serving, noise=F.lit(0.0))
    assert sorted((r.objectid, r.gridid, r.height) for r in df.collect()) == [
        (10, "a", 0), (10, "a", 5), (10, "b", 0), (11, "a", 0), (11, "a", 5), (11, "b", 0)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan[:plan.index("Join")] and "Exchange" not in plan[:plan.index("Join")]


def test_feature_lines_are_dealt_to_all_cores(spark, sf):
    from gridscope_checks.queries_text import feature_lines
    assert feature_lines(spark, sf).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_pairs_per_sample_leave_out_unknown_cells(table):
    mro = table(MRO, *[(1, "u", "t", 50, 1, 1.0, n, 40) for n in (2, 3, None)], (1, "v", "t", 50, 1, 1.0, None, 40))
    finger = table(schemas.FINGER, *[(1, g, 0.0, 0.0, -70.0, n, -80.0, 0) for g, n in (("a", 2), ("a", 3), ("a", None), ("b", None))])
    rows = L.grid_distances(L.candidate_pairs(mro, finger, per="sample"), min_matches=1).collect()
    assert [(r.mmeues1apid, r.gridid, r.distance) for r in rows] == [("u", "a", 0.0)]
    assert [r.gridid for r in L.locate_by_join(mro, finger).collect()] == ["a"]


def _odd_pairs_data(table):
    """Repeats, unknown cells, grids and users without a name, and signals that are no numbers."""
    mro_rows, finger_rows = make_data(22)
    mro_rows += [(0, None, "t", 50, 1, 1.0, n, 40 + (n or 0)) for n in (0, 1, 2, 2, None)] + [(None, "u", "t", 50, 1, 1.0, 0, 40)]
    finger_rows += [(0, None, 0.0, 0.0, -70.0, n, -80.0, 0) for n in (0, 1, 2)] + [(None, "g", 0.0, 0.0, -70.0, 0, -80.0, 0)]
    finger_rows += [(0, "nan", 0.0, 0.0, float("nan"), n, -80.0, None) for n in (0, 1, 2, None)]
    finger_rows += [(9, "far", 0.0, 0.0, float("nan"), n, -80.0, 0) for n in (0, 1)]
    mro_rows += [(9, "v", "t", 50, 1, 1.0, n, 40) for n in (0, 1)]
    return table(MRO, *mro_rows), table(schemas.FINGER, *finger_rows)


READINGS = pa.list_(pa.struct([("cell", pa.int64()), ("gap", pa.float64()), ("n", pa.float64())]))
PAIR_OPTIONS = [{}, {"min_matches": 3, "max_distance": 60.0}, {"min_matches": 1}]


def _small_blocks(monkeypatch):
    monkeypatch.setattr(L, "MOST_ROWS_PER_BLOCK", 30)
    monkeypatch.setattr(L, "ROW_PAIRS_PER_BLOCK", 1500)


@pytest.mark.parametrize("options", PAIR_OPTIONS)
def test_distances_of_blocks_equal_those_per_reading(table, monkeypatch, options):
    _small_blocks(monkeypatch)
    mro, finger = _odd_pairs_data(table)
    columns = ["objectid", "mmeues1apid", "time_stamp", "ltescrsrq", "gridid", "height", "distance"]
    blocks = L.candidate_pairs(mro, finger, per="block")
    assert blocks.select("sample_block").distinct().count() > 1 and blocks.select("finger_block").distinct().count() > 1
    got, want = (sorted(map(str, map(tuple, L.grid_distances(pairs, **options).select(*columns).collect())))
                 for pairs in (blocks, L.candidate_pairs(mro, finger)))
    assert got == want and len(want) > 20


@pytest.mark.parametrize("options", PAIR_OPTIONS)
def test_distances_are_summed_per_grid_before_they_leave_a_block(table, monkeypatch, options):
    _small_blocks(monkeypatch)
    mro, finger = _odd_pairs_data(table)
    blocks = L.candidate_pairs(mro, finger, per="block")
    summed, pairs = L.grid_distances(blocks, per="grid", **options), L.grid_distances(L.candidate_pairs(mro, finger), **options)
    most = blocks.where("known is not null").count()
    assert most < pairs.count() or "max_distance" in options
    assert summed.count() <= most
    grid = ["gridid", "height"]
    got = summed.groupBy(*grid).agg(F.sum("samples"), F.min("nearest"), F.round(F.sum("total") / F.sum("samples"), 6))
    want = pairs.groupBy(*grid).agg(F.count("*"), F.min("distance"), F.round(F.avg("distance"), 6))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


@pytest.mark.parametrize("cells_per_tile,cells_per_chunk", [(1, 1), (25, 40), (4_000_000, 1 << 16)])
def test_tiles_and_chunks_of_a_block_do_not_show(cells_per_tile, cells_per_chunk):
    draw = random.Random(23)

    def side(known, many):
        readings = [[{"cell": draw.randrange(5), "gap": draw.randrange(-9, 9) / 10, "n": float(draw.choice([1, 1, 3]))}
                     for _ in range(draw.randrange(1, 6))] for _ in range(many)]
        names = [f"{k:02d}" for k in range(many)]
        other = [None] * many
        return pa.record_batch({
            "mmeues1apid": pa.array(other if known else names, pa.string()), "gridid": pa.array(names if known else other, pa.string()),
            "height": pa.array([draw.choice([0, 5]) if known else None for _ in range(many)], pa.int32()),
            "seen": pa.array(other if known else readings, READINGS), "known": pa.array(readings if known else other, READINGS)})

    samples, grids = side(False, 30), side(True, 20)
    want = {}
    for s in samples.to_pylist():
        for g in grids.to_pylist():
            met = [(a["n"] * b["n"], (a["gap"] - b["gap"]) ** 2) for a in s["seen"] for b in g["known"] if a["cell"] == b["cell"]]
            if sum(n for n, _ in met) >= 2:
                want[s["mmeues1apid"], g["gridid"]] = (sum(n * v for n, v in met) / sum(n for n, _ in met), g["height"], g["gridid"])
    nearest = {u: min(((round(d, 9), h, g) for (v, _), (d, h, g) in want.items() if v == u)) for u, _ in want}

    def run(per):
        scorer = L._block_scorer(["mmeues1apid"], 2, None, per, cells_per_tile, cells_per_chunk)
        return [r for batch in scorer(iter([samples, grids])) for r in batch.to_pylist()]

    got = {(r["mmeues1apid"], r["gridid"]): (r["distance"], r["height"], r["gridid"]) for r in run(L._PerPair)}
    assert got.keys() == want.keys() and all(got[k][0] == pytest.approx(want[k][0], abs=1e-9) for k in want)
    assert {r["mmeues1apid"]: (r["distance"], r["height"], r["gridid"]) for r in run(L._PerSample)} == nearest
    assert {r["gridid"]: r["samples"] for r in run(L._PerGrid)} == {g: sum(k[1] == g for k in want) for g in {k[1] for k in want}}


def test_indoor_cells_of_the_same_buildings_meet_a_grid_in_few_rows(table, monkeypatch):
    """Lists of cells meet the grids, and only the lists are laid out as rows afterwards; coordinates are rounded once a place."""
    monkeypatch.setattr(fingerprint, "CELLS_PER_ROW", 3)
    draw = random.Random(31)
    covers = {c: draw.choice([(1,), (1,), (2,), (1, 2), (2, 3), (1, 2, 3), ()]) for c in range(40)}
    stands = {f"g{g}": draw.choice([(1,), (2,), (1, 2), (2, 3), (4,), ()]) for g in range(20)}
    sites, cells = table("oid bigint, sitetype int", (1, 0), (2, 1)), [(1 + (c % 5 == 0), c) for c in covers]
    df = fingerprint.indoor_fingerprint(
        sites, table("siteoid bigint, objectid bigint", *cells, *cells),
        table("objectid bigint, buildingid int", *[(c, b) for c, bs in covers.items() for b in bs]),
        table("gridid string, buildingid int", *[(g, b) for g, bs in stands.items() for b in bs]),
        table("gridid string, longitude double, latitude double, height int", *[(g, 117.123456, 32.0, h) for g in stands for h in (0, 5, 5)]),
        noise=F.lit(0.5), decimals=3)
    indoor = {c for site, c in cells if site == 1}
    want = sorted((c, g, 117.123, -80.0, h) for c in indoor for g in stands for h in (0, 5) if set(covers[c]) & set(stands[g]))
    assert sorted((r.objectid, r.gridid, r.longitude, r.rsrp, r.height) for r in df.collect()) == want and len(want) > 300
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "explode(_cells" in plan[:plan.index("Join")] and "round" not in plan[:plan.index("Join")]
    assert df.columns == ["objectid", "gridid", "longitude", "latitude", "rsrp", "height"]
