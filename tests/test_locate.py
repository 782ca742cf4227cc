"""Both locate plans against a plain reading of the definition, with skew and repeats."""

import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gridscope import schemas
from gridscope.operators import locate as L

MRO = "objectid bigint, mmeues1apid string, time_stamp string, ltescrsrp int, ltescrsrq int, " \
      "ltescsinrul double, ncellobjectid bigint, ltencrsrp int"


def brute_force(mro, finger, min_matches=2, max_distance=None):
    sums = defaultdict(list)
    for cell, user, ts, rsrp, rsrq, sinr, neighbour, heard in mro:
        if rsrp is None or heard is None:
            continue
        for f_cell, gridid, _, _, f_rsrp, f_neighbour, f_heard, height in finger:
            if (cell, neighbour) == (f_cell, f_neighbour):
                sums[(cell, user, ts), (rsrp, rsrq, sinr), gridid, height].append(
                    ((rsrp - heard) - (f_rsrp - f_heard)) ** 2)
    best = {}
    for (key, _, gridid, height), gaps in sums.items():
        if len(gaps) < min_matches:
            continue
        found = (sum(gaps) / len(gaps), height, gridid)
        if max_distance is not None and found[0] > max_distance:
            continue
        if key not in best or found < best[key]:
            best[key] = found
    return best


def make_data(seed, samples=60, grids=40, cells=4, neighbours=6):
    rng = random.Random(seed)
    mro, finger = [], []
    for i in range(samples):
        cell = 0 if i % 3 == 0 else rng.randrange(cells)
        ts, rsrp, rsrq = f"t{i % 5}", rng.randrange(98), rng.choice([None, 10, -999])
        for _ in range(rng.randrange(1, 7)):
            row = (cell, f"u{i}", ts, rsrp, rsrq, 3.0, rng.randrange(neighbours), rng.choice([None, *range(40, 60)]))
            mro += [row] * rng.choice([1, 1, 1, 2])
    mro += [mro[0]] * 50
    for g in range(grids):
        cell = 0 if g % 3 == 0 else rng.randrange(cells)
        height, gridid = rng.choice([0, 5, 10]), f"{g % 25}_{g // 25}"
        for n in rng.sample(range(neighbours), rng.randrange(1, neighbours)):
            row = (cell, gridid, 117.0, 32.0, -60.5 - rng.randrange(20), n, -70.0 - rng.randrange(10), height)
            finger += [row] * rng.choice([1, 1, 3])
    return mro, finger


def found(df):
    return {(r.objectid, r.mmeues1apid, r.time_stamp): (r.distance, r.height, r.gridid) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("method", ["join", "blocks", "small blocks"])
def test_locate_equals_brute_force(table, seed, method):
    mro_rows, finger_rows = make_data(seed)
    mro, finger = table(MRO, *mro_rows), table(schemas.FINGER, *finger_rows)
    ground, upper = finger.where("height = 0"), finger.where("height != 0")
    if method == "join":
        result = L.locate_by_join(mro, ground, upper)
    else:
        sizes = {"sample_rows": 7, "finger_rows": 5} if method == "small blocks" else {}
        result = L.locate(mro, ground, upper, **sizes)
    expected = brute_force(mro_rows, finger_rows)
    got = found(result)
    assert got.keys() == expected.keys()
    for key, (distance, height, gridid) in expected.items():
        assert got[key][0] == pytest.approx(distance, abs=1e-9) and got[key][1:] == (height, gridid)


@pytest.mark.parametrize("seed", [4, 5])
def test_near_ties_of_fractional_signals(table, seed):
    """Gaps in tenths and thirds: exact distances, rounded, decide; both plans agree with them."""
    rng = random.Random(seed)
    tenth, third = Fraction(1, 10), Fraction(1, 3)
    grids = [(g, n, rng.choice([-7, -3, -1, 0, 1, 3, 7]) * rng.choice([tenth, third]) - rng.choice([5, 6]))
             for g in range(120) for n in range(4)]
    seen = {u: [rng.randrange(4, 8) for _ in range(4)] for u in range(60)}
    mro = [(0, f"u{u}", "t", 60, 1, 3.0, n, 60 - gaps[n]) for u, gaps in seen.items() for n in range(4)]
    finger = [(0, f"{g:03d}_0", 117.0, 32.0, -60.0, n, float(-60 - gap), 0) for g, n, gap in grids]
    by_grid = defaultdict(list)
    for g, n, gap in grids:
        by_grid[f"{g:03d}_0"].append((n, gap))
    expected = {}
    for u, gaps in seen.items():
        distance, gridid = min((round(sum((gaps[n] - gap) ** 2 for n, gap in known) / 4, L.DECIMALS), gridid)
                               for gridid, known in by_grid.items())
        expected[0, f"u{u}", "t"] = (float(distance), 0, gridid)
    samples, known = table(MRO, *mro, *mro[:40]), table(schemas.FINGER, *finger)
    assert found(L.locate(samples, known, sample_rows=50, finger_rows=100)) == expected
    assert found(L.locate_by_join(samples, known)) == expected


@pytest.mark.parametrize("method", [L.locate_by_join, L.locate])
def test_limits(table, method):
    mro_rows, finger_rows = make_data(9)
    mro, finger = table(MRO, *mro_rows), table(schemas.FINGER, *finger_rows)
    assert found(method(mro, finger, min_matches=3, max_distance=60.0)).keys() == \
        brute_force(mro_rows, finger_rows, 3, 60.0).keys()
    assert found(method(mro, finger, min_matches=1)).keys() == brute_force(mro_rows, finger_rows, 1).keys()


@pytest.mark.parametrize("method", [L.locate_by_join, L.locate])
def test_ties_go_to_the_lower_floor_then_the_smaller_id(table, method):
    mro = table(MRO, (1, "u", "t", 50, 1, 1.0, 2, 40), (1, "u", "t", 50, 1, 1.0, 3, 41))
    rows = [(1, g, 0.0, 0.0, -70.0, n, -80.0, h) for g, h in (("b", 5), ("z", 0), ("c", 0)) for n in (2, 3)]
    assert found(method(mro, table(schemas.FINGER, *rows))) == {(1, "u", "t"): (0.5, 0, "c")}


@pytest.mark.parametrize("method", [L.locate_by_join, L.locate])
def test_carried_columns_stay_with_their_sample(table, method):
    mro_rows, finger_rows = make_data(4)
    mro = table(MRO, *mro_rows).withColumn("day", F.concat(F.lit("d"), "time_stamp"))
    rows = method(mro, table(schemas.FINGER, *finger_rows), carry=("day",)).collect()
    assert rows and all(r.day == "d" + r.time_stamp for r in rows)


def test_nothing_to_match(table):
    mro_rows, finger_rows = make_data(5)
    mro, finger = table(MRO, *mro_rows), table(schemas.FINGER, *finger_rows)
    assert L.locate(mro.where("false"), finger).isEmpty()
    assert L.locate(mro, finger.where("false")).isEmpty()
    assert L.locate(mro.withColumn("ncellobjectid", F.lit(99).cast("bigint")), finger).isEmpty()


def test_many_neighbours_and_grids_go_through_chunks():
    """The scorer cuts its matrices; the cut must not show."""
    import pyarrow as pa

    rng = random.Random(7)
    readings = pa.table({
        "objectid": [1] * 300, "mmeues1apid": [f"u{i // 6}" for i in range(300)], "time_stamp": ["t"] * 300,
        "ltescrsrp": [50] * 300, "ltescrsrq": [1] * 300, "ltescsinrul": [1.0] * 300,
        "ncellobjectid": [rng.randrange(40) for _ in range(300)],
        "n": [1.0] * 300, "gap": [float(g) for g in range(300)], "gap2": [float(g * g) for g in range(300)],
    })
    grids = [(f"g{g:03d}", g % 3, n, rng.randrange(-20, 20)) for g in range(90) for n in rng.sample(range(45), 30)]
    finger = pa.table({
        "objectid": [1] * len(grids), "gridid": [g[0] for g in grids], "height": [g[1] for g in grids],
        "n_objectid": [g[2] for g in grids], "n": [1.0] * len(grids),
        "gap": [float(g[3]) for g in grids], "gap2": [float(g[3] ** 2) for g in grids],
    })
    described = ["objectid", "mmeues1apid", "time_stamp", "ltescrsrp", "ltescrsrq", "ltescsinrul"]
    whole = L._block_matcher(described, 2, None)(readings, finger)
    cut = L._block_matcher(described, 2, None, cells_per_chunk=50, grids_per_tile=7)(readings, finger)
    assert whole.num_rows and whole.equals(cut)


def test_plan_shapes(table, spark):
    mro_rows, finger_rows = make_data(6)
    mro, finger = table(MRO, *mro_rows), table(schemas.FINGER, *finger_rows)
    joined = L.locate_by_join(mro, finger)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in joined and "Cartesian" not in joined and "NestedLoop" not in joined
    blocks = L.locate(mro, finger)._jdf.queryExecution().executedPlan().toString()
    assert blocks.count("FlatMapCoGroupsInArrow") == 1
    for plan in (joined, blocks):
        # Once before the shuffle, once after it.
        assert plan.count("WindowGroupLimit") == 2
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def _field(spark, seed):
    """Grids whose signals follow their place, so that tiles of near grids are alike; samples seen somewhere among them."""
    draw = random.Random(seed)
    sites = {n: (draw.uniform(0, 40), draw.uniform(0, 40)) for n in range(12)}

    def level(n, x, y):
        return -60.0 - 2.5 * ((x - sites[n][0]) ** 2 + (y - sites[n][1]) ** 2) ** 0.5

    grids, rows = [], []
    for x in range(40):
        for y in range(40):
            known = [n for n in range(1, 12) if (x // 10 + y // 20 + n) % 4]
            grids += [(1, f"{x}_{y}", round(level(0, x, y), 1), n, round(level(n, x, y), 1), 0) for n in known]
    for k in range(150):
        x, y = draw.uniform(0, 40), draw.uniform(0, 40)
        for n in draw.sample(range(1, 14), 5):
            far = level(n, x, y) if n in sites else -90.0
            rows.append((1, f"u{k}", "t", int(level(0, x, y)) + 141, 10, 12.0, n, int(far) + 141 + draw.randint(-2, 2)))
        rows += rows[-1:] * draw.randint(0, 2)
    finger = spark.createDataFrame(grids, "objectid long, gridid string, rsrp double, n_objectid long, n_rsrp double, height int")
    mro = spark.createDataFrame(rows, "objectid long, mmeues1apid string, time_stamp string, ltescrsrp int, ltescrsrq int, "
                                      "ltescsinrul double, ncellobjectid long, ltencrsrp int")
    return mro, finger


@pytest.mark.parametrize("min_matches,max_distance", [(2, None), (4, 30.0)])
def test_pruned_tiles_lose_no_minimum(spark, min_matches, max_distance):
    mro, finger = _field(spark, 11)
    options = {"min_matches": min_matches, "max_distance": max_distance}
    want = sorted(map(tuple, L.locate_by_join(mro, finger, **options).select("mmeues1apid", "gridid", "height", "distance").collect()))
    got = sorted(map(tuple, L.locate(mro, finger, **options).select("mmeues1apid", "gridid", "height", "distance").collect()))
    assert got == want and len(want) > 20
    blocks = L.locate(mro, finger, sample_rows=200, finger_rows=3000, **options)
    assert sorted(map(tuple, blocks.select("mmeues1apid", "gridid", "height", "distance").collect())) == want


def test_most_grids_are_not_scored(spark):
    mro, finger = _field(spark, 12)
    row = L.scoring_shares(mro, finger).first()
    assert row.pairs == 150 * 1600 and 0 < row.scored < row.pairs / 3


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"min_matches": 3, "max_distance": 60.0}), (3, {"min_matches": 1})])
def test_all_pairs_in_blocks_equal_brute_force(table, monkeypatch, seed, options):
    """Blocks that cut both sides of a cell; the nearest grid leaves a block once per sample."""
    monkeypatch.setattr(L, "MOST_ROWS_PER_BLOCK", 25)
    mro_rows, finger_rows = make_data(seed)
    mro, finger = table(MRO, *mro_rows), table(schemas.FINGER, *finger_rows)
    result = L.locate_by_join(mro, finger.where("height = 0"), finger.where("height != 0"), per="block", **options)
    expected, got = brute_force(mro_rows, finger_rows, *(options.get(k, v) for k, v in (("min_matches", 2), ("max_distance", None)))), found(result)
    assert got.keys() == expected.keys() and len(got) > 10
    for key, (distance, height, gridid) in expected.items():
        assert got[key][0] == pytest.approx(distance, abs=1e-9) and got[key][1:] == (height, gridid)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Join" not in plan[:plan.index("FlatMapGroupsInArrow")]
