"""Place measurement samples on the fingerprint grid.

A sample is one (objectid, mmeues1apid, time_stamp); its rows are the neighbour
readings. A grid matches by the mean squared gap between the sample's
serving-minus-neighbour difference and the grid's own difference. Distances are rounded to
9 decimals before the threshold and the choice, so that sums taken in another order agree.

Two plans give the same rows. ``locate_by_join`` states the work as join,
aggregate and top-1; it scores all pairs of samples and grids of a cell where they meet, in Spark's own
expressions or block by block in numpy, and shuffles one row per sample and tile or block of grids.
``locate`` cuts both sides into blocks of bounded size per serving cell and
scores block against block with matrix products inside the task. Each sample goes down a tree over tiles of
grids and leaves out the branches whose bound shows that they cannot hold its nearest; only the
inputs, a bounded number of copies of them and one row per sample and block are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridscope.schemas import SAMPLE_KEY, SERVING
from gridscope.sources.tables import cut_lineage

# The block scorer travels with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS_PER_BLOCK = 100_000
FINGER_ROWS_PER_BLOCK = 100_000
#: Rows that one side of a block may grow to before its cell is cut further, whatever the other side has to be copied.
MOST_ROWS_PER_BLOCK = 1_000_000
#: Grids that share one bound, and nodes that share one above them.
GRIDS_PER_TILE = 64
TILES_PER_NODE = 8
#: Pairs of samples and grids that one part of a cell gets where all of them are scored.
PAIRS_PER_PART = 4_000_000
#: Pairs of readings and grid rows that one block gets where all of them are scored in numpy.
ROW_PAIRS_PER_BLOCK = 1 << 33
TASKS_PER_CORE = 4

BLOCK = ("objectid", "sample_block", "finger_block")

#: Decimals of a distance.
DECIMALS = 9


def _reported(mro: DataFrame) -> DataFrame:
    return mro.where(F.col("ltescrsrp").isNotNull() & F.col("ltencrsrp").isNotNull())


def _signed(finger: DataFrame) -> DataFrame:
    return finger.where(F.col("rsrp").isNotNull() & F.col("n_rsrp").isNotNull())


def all_layers(*fingers: DataFrame) -> DataFrame:
    """The columns that matching needs, from ground and upper layers together."""
    needed = [
        f.select("objectid", "gridid", "rsrp", "n_objectid", "n_rsrp", "height") for f in fingers
    ]
    return reduce(DataFrame.unionByName, needed)


def sample_rows(mro: DataFrame) -> DataFrame:
    """The sample columns of reports, with the interference ratio as a double."""
    return mro.select(*SAMPLE_KEY, *SERVING, "ta", "aoa").withColumn("ltescsinrul", F.col("ltescsinrul").cast("double"))


def candidate_pairs(mro: DataFrame, finger: DataFrame, carry: Sequence[str] = (), per: str = "reading") -> DataFrame:
    """Every neighbour reading beside every grid that knows the same cell pair.

    ``per`` says what a row stands for. ``reading``: one reading beside one row of a grid. ``sample``: one sample with its
    readings (``seen``) beside some grids of its cell with theirs (``grids``), so that nothing has to be brought together by
    sample again. ``block``: one sample with its readings (``seen``) or one grid with its rows (``known``); all samples and all
    grids of a block meet, and each sample and grid of a cell meet in one block. ``cell``: all readings of a cell pair beside a
    grid; ``pairs`` counts them and ``gap_sum`` adds their gaps.
    The size of a fingerprint is often guessed too low, so no side is sent whole to every task.
    """
    if per == "sample":
        return _samples_by_grids(mro, finger, carry)
    if per == "block":
        return _blocks_of_both(mro, finger, carry)
    seen, kept = _gaps()
    heard, known = _reported(mro), _signed(finger).withColumn("ncellobjectid", F.col("n_objectid"))
    pair = ["objectid", "ncellobjectid"]
    if per == "reading":
        readings = heard.select(*SAMPLE_KEY, *SERVING, *carry, "ncellobjectid", seen.alias("seen_gap"))
        grids = known.select(*pair, "gridid", "height", kept.alias("grid_gap"))
        return readings.join(grids.hint("merge"), pair)
    readings = heard.groupBy(*pair).agg(F.count(F.lit(1)).alias("_readings"), F.sum(seen).alias("_seen"))
    grids = known.groupBy(*pair, "gridid", "height").agg(F.count(F.lit(1)).alias("_rows"), F.sum(kept).alias("_kept"))
    return readings.join(grids.hint("merge"), pair).select(
        *pair, "gridid", "height", (F.col("_readings") * F.col("_rows")).alias("pairs"),
        (F.col("_seen") * F.col("_rows") - F.col("_kept") * F.col("_readings")).alias("gap_sum"))


def _gaps() -> tuple[Column, Column]:
    """Serving minus neighbour, as a sample has seen it and as a grid knows it."""
    return ((F.col("ltescrsrp") - F.col("ltencrsrp")).cast("double"), (F.col("rsrp") - F.col("n_rsrp")).cast("double"))


def _alike_once(rows: DataFrame, keys: Sequence[str], gap: Column) -> DataFrame:
    return rows.groupBy(*keys, gap.alias("gap")).agg(F.count(F.lit(1)).cast("double").alias("n"))


def _whole_samples(mro: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Each sample with its readings (``seen``); equal readings are one with a count. Written, as blocks are sized from it."""
    described = [*SAMPLE_KEY, *SERVING, *carry]
    readings = _alike_once(_reported(mro), [*described, "ncellobjectid"], _gaps()[0])
    return cut_lineage(readings.groupBy(*described).agg(
        F.collect_list(F.struct(F.col("ncellobjectid").alias("cell"), "gap", "n")).alias("seen")), "seen")


def _known_rows(finger: DataFrame) -> DataFrame:
    """The rows of the grids; equal ones are one with a count."""
    return _alike_once(_signed(finger).where(F.col("n_objectid").isNotNull()), ["objectid", "gridid", "height", "n_objectid"], _gaps()[1])


def _blocks_of_both(mro: DataFrame, finger: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Samples and grids of a cell in blocks: each sample block has a copy for each grid block, and the other way round.

    A block holds ``MOST_ROWS_PER_BLOCK`` rows of a side and ``ROW_PAIRS_PER_BLOCK`` pairs of rows or so. The copies grow with
    the pairs, which is what all pairs cost.
    """
    samples = _whole_samples(mro, carry).withColumn("seen", F.filter("seen", lambda reading: reading["cell"].isNotNull()))
    grids = cut_lineage(_known_rows(finger).groupBy("objectid", "gridid", "height").agg(
        F.collect_list(F.struct(F.col("n_objectid").alias("cell"), "gap", "n")).alias("known")), "known")
    rows, own = F.col("_rows").cast("double"), F.col("_own").cast("double")
    counts = cut_lineage(
        samples.groupBy("objectid").agg(F.sum(F.size("seen")).alias("_rows"))
        .join(grids.groupBy("objectid").agg(F.sum(F.size("known")).alias("_own")), "objectid")
        .withColumn("finger_blocks", F.ceil(own / MOST_ROWS_PER_BLOCK).cast("int"))
        .select("objectid", "finger_blocks", F.greatest(
            F.lit(1), F.ceil(rows / MOST_ROWS_PER_BLOCK),
            F.ceil(rows * own / F.col("finger_blocks") / ROW_PAIRS_PER_BLOCK)).cast("int").alias("sample_blocks")), "blocks")
    sample_side = _in_blocks(samples.join(counts, "objectid"), SAMPLE_KEY[1:], "sample", "finger")
    grid_side = _in_blocks(grids.join(counts, "objectid"), ("gridid", "height"), "finger", "sample")
    # Few rows stand for many pairs, so their size must not decide how many tasks there are.
    tasks = TASKS_PER_CORE * mro.sparkSession.sparkContext.defaultParallelism
    return sample_side.unionByName(grid_side, allowMissingColumns=True).repartition(tasks, *BLOCK)


def _in_blocks(rows: DataFrame, key: Sequence[str], own: str, other: str) -> DataFrame:
    """Rows in one block of their own side, by hash, once for each block of the other side."""
    return (
        rows.withColumn(f"{own}_block", F.pmod(F.xxhash64(*key), F.col(f"{own}_blocks")).cast("int"))
        .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
        .drop("sample_blocks", "finger_blocks")
    )


def _samples_by_grids(mro: DataFrame, finger: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Whole samples beside whole grids of their cell, ``GRIDS_PER_TILE`` grids or so in a row.

    The samples of a cell are dealt to as many parts as its pairs ask for; its grids go to each part. Equal readings of a
    sample or grid are one with a count. Both sides are written: the parts are sized from them.
    """
    described = [*SAMPLE_KEY, *SERVING, *carry]
    samples = _whole_samples(mro, carry)
    grid = ("objectid", "gridid", "height")
    by_cell = _known_rows(finger).groupBy(*grid, "n_objectid").agg(F.collect_list(F.struct("gap", "n")).alias("_readings"))
    grids = cut_lineage(by_cell.groupBy(*grid).agg(
        F.map_from_entries(F.collect_list(F.struct("n_objectid", "_readings"))).alias("known")), "known")
    counts = cut_lineage(
        samples.groupBy("objectid").agg(F.count(F.lit(1)).alias("_samples"))
        .join(grids.groupBy("objectid").agg(F.count(F.lit(1)).alias("_grids")), "objectid")
        .select("objectid", F.ceil(F.col("_samples") * F.col("_grids") / PAIRS_PER_PART).alias("_parts"),
                F.ceil(F.col("_grids") / GRIDS_PER_TILE).alias("_tiles")), "parts")
    tiles = (
        grids.join(counts, "objectid")
        .groupBy("objectid", "_parts", F.pmod(F.xxhash64("gridid", "height"), "_tiles").alias("_tile"))
        .agg(F.collect_list(F.struct("height", "gridid", "known")).alias("grids"))
        .select("objectid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"), "grids")
    )
    dealt = samples.join(counts, "objectid").withColumn("_part", F.pmod(F.xxhash64(*SAMPLE_KEY[1:]), "_parts"))
    # The result is far larger than both sides, so their size must not decide how many tasks there are.
    tasks = TASKS_PER_CORE * mro.sparkSession.sparkContext.defaultParallelism
    left, right = (side.repartition(tasks, "objectid", "_part") for side in (dealt, tiles))
    return left.join(right.hint("merge"), ["objectid", "_part"]).select(*described, "seen", "grids")


def _scored_grids(min_matches: int, max_distance: float | None) -> Column:
    """The (distance, height, gridid) of the ``grids`` of a row that match its ``seen`` readings."""

    def gaps(grid: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("matches"))

        def add(so_far: Column, reading: Column) -> Column:
            same = F.try_element_at(grid["known"], reading["cell"])
            return F.when(same.isNull(), so_far).otherwise(F.aggregate(same, so_far, lambda a, k: F.struct(
                (a["total"] + reading["n"] * k["n"] * (reading["gap"] - k["gap"]) * (reading["gap"] - k["gap"])).alias("total"),
                (a["matches"] + reading["n"] * k["n"]).alias("matches"))))

        return F.aggregate("seen", start, add)

    summed = F.transform("grids", lambda g: F.struct(gaps(g).alias("sums"), g["height"].alias("height"), g["gridid"].alias("gridid")))
    matched = F.filter(summed, lambda g: g["sums"]["matches"] >= max(min_matches, 1))
    scored = F.transform(matched, lambda g: F.struct(
        F.round(g["sums"]["total"] / g["sums"]["matches"], DECIMALS).alias("distance"), g["height"].alias("height"),
        g["gridid"].alias("gridid")))
    return scored if max_distance is None else F.filter(scored, lambda g: g["distance"] <= max_distance)


def grid_distances(pairs: DataFrame, min_matches: int = 2, max_distance: float | None = None,
                   carry: Sequence[str] = (), per: str = "pair") -> DataFrame:
    """A1: mean squared gap per sample and grid, over at least ``min_matches`` rows.

    Pairs per reading are brought together by sample and grid; pairs per sample or block are scored where they are.
    With ``per="grid"`` the distances of a block are summed per grid before they leave the task: how many ``samples``, the
    ``nearest`` and the ``total`` of the distances; a grid has one row for each block that it meets.
    """
    described = [*SAMPLE_KEY, *SERVING, *carry]
    if per == "grid":
        return _scored_blocks(pairs, (), min_matches, max_distance, _PerGrid)
    if "known" in pairs.columns:
        return _scored_blocks(pairs, described, min_matches, max_distance, _PerPair)
    if "seen" in pairs.columns:
        return pairs.select(*described, F.explode(_scored_grids(min_matches, max_distance)).alias("_grid")) \
            .select(*described, "_grid.gridid", "_grid.height", "_grid.distance")
    gap = F.col("seen_gap") - F.col("grid_gap")
    scored = (
        pairs.groupBy(*described, "gridid", "height")
        .agg(F.round(F.avg(gap * gap), DECIMALS).alias("distance"), F.count(F.lit(1)).alias("matches"))
        .where(F.col("matches") >= min_matches)
        .drop("matches")
    )
    return scored if max_distance is None else scored.where(F.col("distance") <= max_distance)


def nearest_of_row(pairs: DataFrame, min_matches: int = 2, max_distance: float | None = None,
                   carry: Sequence[str] = ()) -> DataFrame:
    """A1 of pairs per sample or block, reduced to the nearest grid of each row or sample of a block before anything is shuffled."""
    described = [*SAMPLE_KEY, *SERVING, *carry]
    if "known" in pairs.columns:
        return _scored_blocks(pairs, described, min_matches, max_distance, _PerSample)
    return pairs.select(*described, F.array_min(_scored_grids(min_matches, max_distance)).alias("_grid")) \
        .where(F.col("_grid").isNotNull()).select(*described, "_grid.gridid", "_grid.height", "_grid.distance")


def best_grid(distances: DataFrame) -> DataFrame:
    """Nearest grid of each sample; ties go to the lower floor, then the smaller grid id."""
    order = Window.partitionBy(*SAMPLE_KEY).orderBy(
        "distance", "height", "gridid", *[F.col(c).asc_nulls_last() for c in SERVING]
    )
    return (
        distances.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def locate_by_join(mro: DataFrame, *fingers: DataFrame, min_matches: int = 2,
                   max_distance: float | None = None, carry: Sequence[str] = (), per: str = "sample") -> DataFrame:
    """C6 as join, aggregate and top-1: all pairs of samples and grids of a cell are scored.

    With ``per="block"`` tasks score them block by block in numpy, which is far faster; else Spark's own expressions do.
    """
    pairs = candidate_pairs(mro, all_layers(*fingers), carry, per=per)
    return best_grid(nearest_of_row(pairs, min_matches, max_distance, carry))


def _scored_blocks(pairs: DataFrame, described: Sequence[str], min_matches: int, max_distance: float | None, per) -> DataFrame:
    """What ``per`` makes of the distances of all pairs of samples and grids of each block."""
    types = dict(pairs.dtypes)
    needed = [*BLOCK, *(c for c in described if c not in BLOCK), "seen", "gridid", "height", "known"]
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in described), *per.SCHEMA])
    return pairs.select(*needed).groupBy(*BLOCK).applyInArrow(_block_scorer(list(described), min_matches, max_distance, per), schema)


def _block_scorer(described, min_matches, max_distance, per, cells_per_tile=4_000_000, cells_per_chunk=1 << 16):
    """Task-side scorer of all pairs of a block.

    The grids are cut so that their gaps by neighbour fit ``cells_per_tile``; the samples with as many readings as each
    other are scored together, reading by reading, ``cells_per_chunk`` distances at once. The squared gaps of a reading and
    the rows of a grid are their number times the squared gap to their mean, and what they differ from it.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        samples, grids = (table.filter(table[side].is_valid()) for side in ("seen", "known"))
        if not samples.num_rows or not grids.num_rows:
            return
        # In the order of ties.
        grids = grids.take(pc.sort_indices(grids, [("height", "ascending"), ("gridid", "ascending")], null_placement="at_start"))
        out = per(samples.select(described), grids.select(["gridid", "height"]))
        owner, cell, gap, n = _readings(grids["known"])
        shared, cell = np.unique(cell, return_inverse=True)
        alike = list(_by_size(*_readings(samples["seen"]), shared))
        step = max(1, cells_per_tile // len(shared))
        for first in range(0, grids.num_rows, step):
            last = min(first + step, grids.num_rows)
            tile = slice(*np.searchsorted(owner, (first, last)))
            known = _Known(owner[tile] - first, cell[tile], gap[tile], n[tile], (len(shared), last - first))
            chunk = max(1, cells_per_chunk // (last - first))
            for rows, *readings in alike:
                for start in range(0, len(rows), chunk):
                    part = slice(start, start + chunk)
                    distance, allowed = known.distances(*(a[part] for a in readings), max(min_matches, 1))
                    if distance is None:
                        continue
                    if max_distance is not None:
                        near = distance <= max_distance
                        allowed = near if allowed is None else allowed & near
                    if allowed is None or allowed.any():
                        yield from out.add(rows[part], first, distance, allowed)
        yield from out.rest()

    return score


def _readings(lists: pa.ChunkedArray) -> tuple[np.ndarray, ...]:
    """The number of the list, cell, gap and count of each reading."""
    lists = lists.combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return owner, *(lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in ("cell", "gap", "n"))


def _by_size(owner, cell, gap, n, shared) -> Iterator[tuple[np.ndarray, ...]]:
    """Samples with as many readings of shared neighbours: their numbers, and a row per sample of places in ``shared``, gaps and
    counts. Samples whose counts are all 1 are apart."""
    at = np.minimum(np.searchsorted(shared, cell), len(shared) - 1)
    keep = shared[at] == cell
    owner, at, gap, n = owner[keep], at[keep], gap[keep], n[keep]
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    if not len(starts):
        return
    sizes = np.diff(np.append(starts, len(owner)))
    repeated = np.maximum.reduceat(n, starts) > 1
    for size, more in np.unique(np.column_stack([sizes, repeated]), axis=0).tolist():
        chosen = starts[(sizes == size) & (repeated == more)]
        rows = chosen[:, None] + np.arange(size)
        yield owner[chosen], at[rows], gap[rows], n[rows]


class _Known:
    """Some grids: count, mean and spread of their rows by neighbour."""

    def __init__(self, owner, cell, gap, n, shape):
        place = cell * shape[1] + owner

        def summed(values):
            return np.bincount(place, weights=values, minlength=shape[0] * shape[1])

        self.count = summed(n)
        self.mean = np.divide(summed(n * gap), self.count, out=np.zeros(len(self.count)), where=self.count > 0)
        once = bool((self.count == 1).all())
        self.spread = None
        if (self.count > 1).any():
            off = np.where(self.count[place] > 1, gap - self.mean[place], 0.0)
            self.spread = summed(n * off * off).reshape(shape)
        self.count, self.mean = None if once else self.count.reshape(shape), self.mean.reshape(shape)

    def distances(self, at, gap, n, least) -> tuple[np.ndarray | None, np.ndarray | None]:
        """Rounded distance of each sample to each grid, and which have ``least`` pairs of rows; None stands for all.

        The distance is not a number where there are fewer, and None if that holds for all.
        """
        shape = len(at), self.mean.shape[1]
        once = self.count is None and bool((n == 1).all())
        if once and at.shape[1] < least:
            return None, None
        total, off, held, pairs = np.zeros(shape), np.empty(shape), np.empty(shape), None if once else np.zeros(shape)
        for k in range(at.shape[1]):
            np.take(self.mean, at[:, k], axis=0, out=off, mode="clip")
            off -= gap[:, k, None]
            off *= off
            if not once:
                if self.count is None:
                    held.fill(1.0)
                else:
                    np.take(self.count, at[:, k], axis=0, out=held, mode="clip")
                held *= n[:, k, None]
                pairs += held
                off *= held
                if self.spread is not None:
                    off += n[:, k, None] * self.spread[at[:, k]]
            total += off
        if once:
            total /= at.shape[1]
            return np.round(total, DECIMALS, out=total), None
        allowed = pairs >= least
        distance = np.divide(total, pairs, out=np.full(shape, np.nan), where=allowed)
        return np.round(distance, DECIMALS, out=distance), None if allowed.all() else allowed


class _PerGrid:
    """How many samples each grid has, the least of their distances and the sum."""

    SCHEMA = ("gridid string", "height int", "samples long", "nearest double", "total double")

    def __init__(self, samples, grids):
        self.grids = grids
        self.samples, self.total = np.zeros(grids.num_rows, dtype=np.int64), np.zeros(grids.num_rows)
        self.nearest = np.full(grids.num_rows, np.nan)

    def add(self, rows, first, distance, allowed):
        some = slice(first, first + distance.shape[1])
        if allowed is None:
            self.samples[some] += len(rows)
            self.total[some] += distance.sum(axis=0)
        else:
            self.samples[some] += allowed.sum(axis=0)
            self.total[some] += distance.sum(axis=0, where=allowed)
            distance = np.where(allowed, distance, np.nan)
        self.nearest[some] = np.fmin(self.nearest[some], np.fmin.reduce(distance, axis=0))
        return ()

    def rest(self):
        met = np.flatnonzero(self.samples)
        yield from _beside(self.grids.take(met), samples=self.samples[met], nearest=self.nearest[met], total=self.total[met])


class _PerSample:
    """The nearest grid of each sample, the first of those equally near."""

    SCHEMA = ("gridid string", "height int", "distance double")

    def __init__(self, samples, grids):
        self.samples, self.grids = samples, grids
        self.best, self.at = np.full(samples.num_rows, np.nan), np.full(samples.num_rows, -1)

    def add(self, rows, first, distance, allowed):
        value = distance if allowed is None else np.where(allowed, distance, np.inf)
        place = value.argmin(axis=1)
        found = np.ones(len(rows), dtype=bool) if allowed is None else allowed.any(axis=1)
        value = value[np.arange(len(rows)), place]
        for k in np.flatnonzero(found & ~np.isfinite(value)).tolist():
            # not a number is further than any
            can = np.arange(distance.shape[1]) if allowed is None else np.flatnonzero(allowed[k])
            numbers = can[~np.isnan(distance[k, can])]
            place[k] = numbers[distance[k, numbers].argmin()] if len(numbers) else can[0]
            value[k] = distance[k, place[k]]
        best = self.best[rows]
        better = found & ((self.at[rows] < 0) | (value < best) | (np.isnan(best) & ~np.isnan(value)))
        self.best[rows[better]], self.at[rows[better]] = value[better], first + place[better]
        return ()

    def rest(self):
        found = np.flatnonzero(self.at >= 0)
        yield from _beside(self.samples.take(found), self.grids.take(self.at[found]), distance=self.best[found])


class _PerPair:
    """Each sample beside each grid that matches."""

    SCHEMA = _PerSample.SCHEMA

    def __init__(self, samples, grids):
        self.samples, self.grids = samples, grids

    def add(self, rows, first, distance, allowed):
        i, j = np.nonzero(np.ones(distance.shape, dtype=bool) if allowed is None else allowed)
        yield from _beside(self.samples.take(rows[i]), self.grids.take(first + j), distance=distance[i, j])

    def rest(self):
        return ()


def _beside(*tables: pa.Table, **columns) -> Iterator[pa.RecordBatch]:
    """The columns of all in one table."""
    found = {name: table[name] for table in tables for name in table.column_names}
    yield from pa.table(found | columns).to_batches()


def block_counts(readings: DataFrame, finger: DataFrame, sample_rows: int, finger_rows: int) -> DataFrame:
    """How many sample and fingerprint blocks each serving cell is cut into, from the folded rows of both sides.

    Each block of one side is sent to each block of the other. A cell is cut as asked as long as the copies of a side are no
    more than both sides together; beyond that its blocks grow, up to ``MOST_ROWS_PER_BLOCK``.
    """
    both = F.col("_samples") + F.col("_grids")

    def blocks(own: str, other: str, rows: int) -> Column:
        asked, least = F.ceil(F.col(own) / rows), F.ceil(F.col(own) / MOST_ROWS_PER_BLOCK)
        return F.least(asked, F.greatest(least, 1 + F.floor(both / F.col(other)))).cast("int")

    return readings.groupBy("objectid").agg(F.count(F.lit(1)).alias("_samples")).join(
        finger.groupBy("objectid").agg(F.count(F.lit(1)).alias("_grids")), "objectid").select(
        "objectid", blocks("_samples", "_grids", sample_rows).alias("sample_blocks"),
        blocks("_grids", "_samples", finger_rows).alias("finger_blocks"))


def folded(mro: DataFrame, finger: DataFrame, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Count, sum and sum of squares of the gaps per sample and neighbour, and per grid and neighbour.

    Both are written: the blocks are sized from them before they are dealt out, and the reports are scanned once.
    """
    seen = (F.col("ltescrsrp") - F.col("ltencrsrp")).cast("double")
    kept = (F.col("rsrp") - F.col("n_rsrp")).cast("double")

    def measures(gap: Column) -> list[Column]:
        return [F.count(F.lit(1)).cast("double").alias("n"), F.sum(gap).alias("gap"), F.sum(gap * gap).alias("gap2")]

    readings = _reported(mro).groupBy(*SAMPLE_KEY, *SERVING, *carry, "ncellobjectid").agg(*measures(seen))
    grids = _signed(finger).groupBy("objectid", "gridid", "height", "n_objectid").agg(*measures(kept))
    return cut_lineage(readings, "readings"), cut_lineage(grids, "grids")


def locate(mro: DataFrame, *fingers: DataFrame, min_matches: int = 2,
           max_distance: float | None = None, carry: Sequence[str] = (),
           sample_rows: int = SAMPLE_ROWS_PER_BLOCK,
           finger_rows: int = FINGER_ROWS_PER_BLOCK) -> DataFrame:
    """Each located sample with its grid, floor and distance.

    Repeated rows are folded into counts and sums first, so a repeated sample or
    fingerprint row costs nothing later. ``carry`` names further columns that
    belong to the sample (such as day and hour).
    """
    sample_side, finger_side = _dealt(mro, fingers, carry, sample_rows, finger_rows)
    described = [*SAMPLE_KEY, *SERVING, *carry]
    types = dict(sample_side.select(*described).dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in described)
    by_block = (
        sample_side.groupBy(*BLOCK)
        .cogroup(finger_side.groupBy(*BLOCK))
        .applyInArrow(
            _block_matcher(described, min_matches, max_distance),
            f"{schema}, gridid string, height int, distance double",
        )
    )
    return best_grid(by_block)


def scoring_shares(mro: DataFrame, *fingers: DataFrame, min_matches: int = 2, max_distance: float | None = None,
                   sample_rows: int = SAMPLE_ROWS_PER_BLOCK, finger_rows: int = FINGER_ROWS_PER_BLOCK) -> DataFrame:
    """What ``locate`` has to score: per cell all pairs of samples and grids, and those whose tile could hold a minimum."""
    sample_side, finger_side = _dealt(mro, fingers, (), sample_rows, finger_rows)
    counted = sample_side.groupBy(*BLOCK).cogroup(finger_side.groupBy(*BLOCK)).applyInArrow(
        _block_matcher([*SAMPLE_KEY, *SERVING], min_matches, max_distance, report=True),
        "objectid long, pairs long, scored long")
    return counted.groupBy("objectid").agg(F.sum("pairs").alias("pairs"), F.sum("scored").alias("scored"))


def _dealt(mro: DataFrame, fingers: Sequence[DataFrame], carry: Sequence[str], sample_rows: int,
           finger_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both folded sides with their blocks: each sample block beside each fingerprint block of its cell."""
    readings, finger = folded(mro, all_layers(*fingers), carry)
    # One row per cell. Written, so that its size is known when the joins are planned.
    counts = cut_lineage(block_counts(readings, finger, sample_rows, finger_rows), "blocks")

    def block_of(columns, blocks: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.col(blocks))

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    sample_side = (
        readings.join(counts, "objectid")
        .withColumn("sample_block", block_of(SAMPLE_KEY[1:], "sample_blocks").cast("int"))
        .withColumn("finger_block", every("finger_blocks"))
        .drop("sample_blocks", "finger_blocks")
    )
    finger_side = (
        finger.join(counts, "objectid")
        .withColumn("finger_block", block_of(("gridid", "height"), "finger_blocks").cast("int"))
        .withColumn("sample_block", every("sample_blocks"))
        .drop("sample_blocks", "finger_blocks")
    )
    return sample_side, finger_side


def _codes(table: pa.Table, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each row by the columns, and the first row of each group."""
    code = np.zeros(table.num_rows, dtype=np.int64)
    for name in columns:
        part = table[name].combine_chunks().dictionary_encode(null_encoding="encode")
        if isinstance(part, pa.ChunkedArray):
            part = part.combine_chunks()
        index = part.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        _, code = np.unique(code * (len(part.dictionary) + 1) + index, return_inverse=True)
    _, first, code = np.unique(code, return_index=True, return_inverse=True)
    return code, first


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def _block_matcher(described, min_matches, max_distance, cells_per_chunk=2_000_000, grids_per_tile=GRIDS_PER_TILE, report=False):
    """Task-side scorer of one sample block against one fingerprint block.

    Grids alike lie together in tiles, tiles alike in nodes. The least and largest gap of a node per neighbour bound the
    distance of a sample to all its grids from below; each sample is scored against the tile at the end of its least bounds
    first and then goes down only into nodes whose bound does not exceed what was found. No grid that can be nearest is
    left out. Of grids with equal readings only the first in the order of ties can be chosen.

    With count n, sum s and sum of squares q per neighbour on either side, the
    squared gaps of all row pairs add up to q_r*n_g - 2*s_r*s_g + n_r*q_g, which
    is three matrix products over the shared neighbours. The products cancel, so unless
    all their terms are exact, every grid that comes close to a sample's minimum is
    scored again by its gaps.
    """

    def match(readings: pa.Table, finger: pa.Table) -> pa.Table:
        described_part = readings.select(described)
        if not readings.num_rows or not finger.num_rows:
            return _counted([], [], []) if report else _result(described_part.slice(0, 0), [], [], [])
        # Grids are numbered in (height, gridid) order, so that the least number is the wanted tie.
        finger = finger.sort_by([("height", "ascending"), ("gridid", "ascending")])
        grid, grid_first = _codes_in_order(finger, ("height", "gridid"))
        sample, sample_first = _codes(described_part, described)
        shared, (r_nb, g_nb), (r_keep, g_keep) = _shared_neighbours(
            _numbers(readings, "ncellobjectid"), _numbers(finger, "n_objectid"))
        r = [a[r_keep] for a in (sample, *(_numbers(readings, c) for c in ("n", "gap", "gap2")))]
        g = [a[g_keep] for a in (grid, *(_numbers(finger, c) for c in ("n", "gap", "gap2")))]
        n_samples, n_grids = len(sample_first), len(grid_first)
        by_sample = np.argsort(r[0], kind="stable")
        r, r_nb = [a[by_sample] for a in r], r_nb[by_sample]
        starts = np.searchsorted(r[0], np.arange(n_samples + 1))
        exact = _exact(r) and _exact(g)
        margin = _margin(r, g)
        g, g_nb, kept = _first_of_alike(g, g_nb)
        tiles = _Tiles(g, g_nb, len(kept), shared, grids_per_tile)
        limit = np.inf if max_distance is None else max_distance
        best = np.full(n_samples, np.inf)
        best_at = np.full(n_samples, n_grids, dtype=np.int64)
        step = max(1, cells_per_chunk // max(3 * shared, len(tiles.grids), 1))
        scored = 0

        def score(number: int, rows: np.ndarray, first: int, side) -> None:
            grids, columns, known = tiles.grids[number], tiles.columns[number], tiles.sides[number]
            at = np.ix_(rows, columns)
            (rn, rs, rq), (gn, gs, gq) = (part[at] for part in side), known
            total = np.hstack([rq, -2.0 * rs, rn]) @ np.hstack([gn, gs, gq]).T
            pairs = rn @ gn.T
            allowed = pairs >= max(min_matches, 1)
            distance = np.full_like(total, np.inf)
            np.divide(np.maximum(total, 0.0), pairs, out=distance, where=allowed)
            i, j = np.nonzero((distance <= distance.min(axis=1, keepdims=True) + margin) & allowed)
            close = distance[i, j] if exact else _direct((rn, rs, rq), i, (gn, gs, gq), j) / pairs[i, j]
            distance[i, j] = np.round(close, DECIMALS)
            near = distance.argmin(axis=1)
            value, found = distance[np.arange(len(near)), near], kept[grids[near]]
            rows = rows + first
            better = (value < best[rows]) | ((value == best[rows]) & (found < best_at[rows]) & (value < np.inf))
            best[rows[better]], best_at[rows[better]] = value[better], found[better]

        for first in range(0, n_samples, step):
            last = min(first + step, n_samples)
            part = slice(starts[first], starts[last])
            side = _dense([a[part] for a in r], r_nb[part], (first, last), (0, shared))

            def bounds(owner, level, node):
                return tiles.bounds(level, node, r, r_nb, starts, owner + first, max(min_matches, 1))

            # Down to the tile at the end of each sample's least bounds.
            all_rows = np.arange(last - first)
            owner, node = np.repeat(all_rows, tiles.size(0)), np.tile(np.arange(tiles.size(0)), last - first)
            top = bound = bounds(owner, 0, node)
            for level in range(tiles.levels):
                if level:
                    owner, node = tiles.children(level, owner, node)
                    bound = bounds(owner, level, node)
                order = np.lexsort((bound, owner))
                lead = order[np.flatnonzero(np.diff(owner[order], prepend=-1))]
                owner, node, bound = owner[lead], node[lead], bound[lead]
            nearest = np.full(last - first, -1)
            go = (bound <= limit + margin) & (bound < np.inf)
            nearest[owner[go]] = node[go]
            for number, rows in _by_number(node[go], owner[go]):
                score(number, rows, first, side)
                scored += len(rows) * len(tiles.grids[number])
            # Down into every other node that can hold something as near.
            owner, node = np.repeat(all_rows, tiles.size(0)), np.tile(np.arange(tiles.size(0)), last - first)
            bound = top
            for level in range(tiles.levels):
                if level:
                    owner, node = tiles.children(level, owner, node)
                    bound = bounds(owner, level, node)
                reach = np.minimum(best[first:last], limit) + margin
                go = np.flatnonzero((bound <= reach[owner]) & (bound < np.inf))
                owner, node, bound = owner[go], node[go], bound[go]
            go = np.flatnonzero(node != nearest[owner])
            for number, at in _by_number(node[go], go):
                rows = owner[at]
                rows = rows[bound[at] <= np.minimum(best[rows + first], limit) + margin]
                if len(rows):
                    score(number, rows, first, side)
                    scored += len(rows) * len(tiles.grids[number])
        if report:
            return _counted([readings["objectid"][0].as_py()], [n_samples * n_grids], [scored])
        found = np.flatnonzero((best_at < n_grids) & (best <= limit))
        rows = grid_first[best_at[found]]
        return _result(
            described_part.take(sample_first[found]),
            finger["gridid"].take(rows), finger["height"].take(rows), best[found],
        )

    return match


def _by_number(numbers: np.ndarray, values: np.ndarray):
    """The values of each number, least number first."""
    order = np.argsort(numbers, kind="stable")
    found, starts = np.unique(numbers[order], return_index=True)
    return zip(found.tolist(), np.split(values[order], starts[1:]))


def _first_of_alike(g, neighbour):
    """The readings of the first grid of each set of grids with equal readings, numbered anew, and their old numbers."""
    order = np.lexsort((neighbour, g[0]))
    owner, *values = (a[order] for a in g)
    neighbour = neighbour[order]
    readings = np.column_stack([neighbour.astype(np.float64), *values])
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    ends = np.append(starts[1:], len(owner))
    seen, take = set(), []
    for at, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
        key = readings[start:end].tobytes()
        if key not in seen:
            seen.add(key)
            take.append(at)
    take = np.array(take, dtype=np.int64)
    sizes = (ends - starts)[take]
    rows = _ranges(starts[take], sizes)
    return [np.repeat(np.arange(len(take)), sizes), *(v[rows] for v in values)], neighbour[rows], owner[starts[take]]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


class _Tiles:
    """Grids in tiles of those alike, each with its readings, under levels of nodes with the least and largest of them.

    Level 0 has at most ``TILES_PER_NODE`` nodes, the last level is the tiles.
    """

    def __init__(self, g, neighbour, n_grids, shared, size, dimensions=16):
        self.grids = _halved(_profile(g, neighbour, n_grids, shared, dimensions), size)
        tile, place = np.zeros(n_grids, dtype=np.int64), np.zeros(n_grids, dtype=np.int64)
        for number, grids in enumerate(self.grids):
            tile[grids], place[grids] = number, np.arange(len(grids))
        shape = (shared, len(self.grids))
        owner, n, gap, _ = g
        cell = neighbour * shape[1] + tile[owner]
        low, high = np.full(shape, np.inf), np.full(shape, -np.inf)
        least, most = np.full(shape, np.inf), np.zeros(shape)
        for bound, take, values in ((low, np.minimum, gap / n), (high, np.maximum, gap / n),
                                    (least, np.minimum, n), (most, np.maximum, n)):
            take.at(bound.reshape(-1), cell, values)
        held = np.bincount(cell, minlength=shape[0] * shape[1]).reshape(shape)
        # a neighbour that some grid of the tile lacks bounds nothing
        least[held < np.array([len(grids) for grids in self.grids])] = 0.0
        low[held == 0], high[held == 0] = -np.inf, np.inf
        self.nodes = [(low, high, least, most)]
        while self.nodes[0][0].shape[1] > TILES_PER_NODE:
            cuts = np.arange(0, self.nodes[0][0].shape[1], TILES_PER_NODE)
            merge = (np.minimum, np.maximum, np.minimum, np.maximum)
            self.nodes.insert(0, tuple(take.reduceat(part, cuts, axis=1) for take, part in zip(merge, self.nodes[0])))
        self.levels = len(self.nodes)
        self.columns, self.sides = [], []
        order = np.argsort(tile[owner], kind="stable")
        cuts = np.searchsorted(tile[owner][order], np.arange(len(self.grids) + 1))
        for number, grids in enumerate(self.grids):
            rows = order[cuts[number]: cuts[number + 1]]
            columns, column = np.unique(neighbour[rows], return_inverse=True)
            part = [place[owner[rows]], *(values[rows] for values in g[1:])]
            self.columns.append(columns)
            self.sides.append(_dense(part, column, (0, len(grids)), (0, len(columns))))

    def size(self, level: int) -> int:
        return self.nodes[level][0].shape[1]

    def children(self, level: int, owner: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of a level under those of the level above, each with its owner."""
        start = node * TILES_PER_NODE
        sizes = np.minimum(TILES_PER_NODE, self.size(level) - start)
        return np.repeat(owner, sizes), _ranges(start, sizes)

    def bounds(self, level, node, r, neighbour, starts, sample, min_matches, rows_at_once=1_000_000) -> np.ndarray:
        """No more than the distance of each sample to any grid of the node beside it; infinite where none can match."""
        low, high, least, most = self.nodes[level]
        bound = np.full(len(sample), np.inf)
        sizes = starts[sample + 1] - starts[sample]
        ends = np.cumsum(sizes)
        first = 0
        while first < len(sample):
            before = ends[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(ends, before + rows_at_once, side="right")))
            some = first + np.flatnonzero(sizes[first:last])
            if len(some):
                rows = _ranges(starts[sample[some]], sizes[some])
                at = neighbour[rows], np.repeat(node[some], sizes[some])
                n, seen = r[1][rows], r[2][rows] / r[1][rows]
                out = np.maximum(np.maximum(low[at] - seen, seen - high[at]), 0.0)
                cuts = np.cumsum(sizes[some]) - sizes[some]
                total = np.add.reduceat(n * least[at] * out * out, cuts)
                pairs = np.add.reduceat(n * most[at], cuts)
                bound[some] = np.divide(total, pairs, out=np.full(len(some), np.inf), where=pairs >= min_matches)
            first = last
        return bound


def _profile(g, neighbour, n_grids, shared, dimensions) -> np.ndarray:
    """Mean gap of each grid for the neighbours that most grids know; one far below all others where it is unknown."""
    owner, n, gap, _ = g
    common = np.argsort(-np.bincount(neighbour, minlength=shared), kind="stable")[:dimensions]
    column = np.full(shared, -1)
    column[common] = np.arange(len(common))
    value = gap / n
    profile = np.full((n_grids, len(common)), (value.min() if len(value) else 0.0) - 1000.0)
    kept = column[neighbour] >= 0
    profile[owner[kept], column[neighbour[kept]]] = value[kept]
    return profile


def _halved(profile: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in parts of at most ``size``, cut again and again where the values of a part spread most."""
    done, todo = [], [np.arange(len(profile))]
    while todo:
        part = todo.pop()
        if len(part) <= size:
            done.append(np.sort(part))
            continue
        held = profile[part]
        widest = int(np.ptp(held, axis=0).argmax()) if held.shape[1] else 0
        order = part[np.argsort(held[:, widest], kind="stable")] if held.shape[1] else part
        todo += [order[: len(order) // 2], order[len(order) // 2:]]
    return done


def _counted(objectid, pairs, scored) -> pa.Table:
    return pa.table([pa.array(values, pa.int64()) for values in (objectid, pairs, scored)], ["objectid", "pairs", "scored"])


def _exact(side) -> bool:
    """Whether all sums are multiples of 1/1024 so small that their products lose nothing."""
    return all(np.array_equal(v * 1024, np.rint(v * 1024)) and (not len(v) or np.abs(v).max() < 1e6) for v in side[1:])


def _margin(r, g) -> float:
    """More than the products can be wrong by, as a mean over the row pairs."""
    largest = sum(float((side[3] / side[1]).max()) if len(side[1]) else 0.0 for side in (r, g))
    return 4 * 10.0 ** -DECIMALS + 1e-11 * largest


def _direct(seen, i, known, j, pairs_at_once=4096) -> np.ndarray:
    """Sum of the squared gaps of samples ``i`` and grids ``j``, rows of the dense sides.

    Per neighbour it is n_r*n_g times the squared gap of the means, and what the rows of each
    side differ from their mean.
    """

    def centred(side):
        n, gap, gap2 = side
        mean = np.divide(gap, n, out=np.zeros_like(gap), where=n > 0)
        return n, mean, np.where(n > 1, np.maximum(gap2 - gap * mean, 0.0), 0.0)

    (rn, rm, rv), (gn, gm, gv) = centred(seen), centred(known)
    total = np.zeros(len(i))
    for at in range(0, len(i), pairs_at_once):
        a, b = i[at: at + pairs_at_once], j[at: at + pairs_at_once]
        gaps = rn[a] * gn[b] * (rm[a] - gm[b]) ** 2 + gn[b] * rv[a] + rn[a] * gv[b]
        total[at: at + pairs_at_once] = gaps.sum(axis=1)
    return total


def _codes_in_order(table: pa.Table, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of a table already sorted by the columns, counted in that order."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for name in columns:
        part = table[name].combine_chunks().dictionary_encode(null_encoding="encode")
        if isinstance(part, pa.ChunkedArray):
            part = part.combine_chunks()
        index = part.indices.to_numpy(zero_copy_only=False)
        new[1:] |= index[1:] != index[:-1]
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _shared_neighbours(seen: np.ndarray, known: np.ndarray):
    """Number the neighbours that both sides know; mask the rows of the others."""
    shared = np.intersect1d(seen, known)

    def place(values):
        at = np.searchsorted(shared, values)
        keep = np.zeros(len(values), dtype=bool)
        inside = at < len(shared)
        keep[inside] = shared[at[inside]] == values[inside]
        return at[keep], keep

    (r_at, r_keep), (g_at, g_keep) = place(seen), place(known)
    return len(shared), (r_at, g_at), (r_keep, g_keep)


def _dense(parts, neighbour, rows, columns):
    """Three dense matrices (count, sum, sum of squares) of a row range and a neighbour range."""
    owner, *values = parts
    shape = (rows[1] - rows[0], columns[1] - columns[0])
    pick = ((owner >= rows[0]) & (owner < rows[1])
            & (neighbour >= columns[0]) & (neighbour < columns[1]))
    cell = (owner[pick] - rows[0]) * shape[1] + (neighbour[pick] - columns[0])
    return [
        np.bincount(cell, weights=v[pick], minlength=shape[0] * shape[1]).reshape(shape)
        for v in values
    ]


def _result(described: pa.Table, gridid, height, distance) -> pa.Table:
    out = described
    out = out.append_column("gridid", _as(gridid, pa.string()))
    out = out.append_column("height", _as(height, pa.int32()))
    return out.append_column("distance", _as(distance, pa.float64()))


def _as(values, kind: pa.DataType):
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return values.cast(kind)
    return pa.array(values, type=kind)
