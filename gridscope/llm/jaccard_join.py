"""Operator 3: n-gram Jaccard join by chosen paths.

A text is the set of its shingles of five words (of all its words where it has fewer). Texts of equal sets
form a class; the join is between classes. Each class has a minhash signature, and each place of it
is a token (place, value) that two sets share with a chance equal to their similarity. A run splits all
classes into buckets: at each node a random place is chosen, and a second one with the chance that
makes 1 / 0.8 places on average, and a class goes to the child of its value there. Buckets
that are small, or that a further split would not shrink, are compared pair by pair; the others are split
again. Runs are repeated so often that a pair at the threshold is missed with less than the chance
``1 - TARGET_RECALL``.

A pair that meets in several buckets is compared in the least of them only, so no pair is ever
shuffled: a class carries the list of its buckets (a few per run). Large buckets are cut into blocks, and
each pair of blocks is compared by itself, in bounded memory. Signatures tell first which classes
have a partner; only those are sent with their whole sets, for the exact similarity.

Result per document: ``class_id`` (the least key of its connected component) and ``n_links``, the
number of other documents whose similarity is at least the threshold, copies included.

Defined results: a null or blank text links with nothing and is its own class; texts of equal sets have
similarity 1; a similarity of exactly 0.8 is a link; a class without any key has a null ``class_id``, though
its rows are linked like others; repeated rows count as documents; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscope.llm import textarrays as ta
from gridscope.llm.components import connected_components
from gridscope.llm.sorted_groups import complete_groups
from gridscope.sources.tables import cut_lineage

WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
#: Places of a signature.
PLACES = 128
#: Classes of a bucket that are compared without another split, and classes of a block.
BLOCK = 512
#: A bucket that keeps such a part of its parent's classes is compared as it is.
STALLED = 0.5
DEPTH = 3
#: Least chance that a pair at the threshold shares a bucket at that depth in one run.
RUN_RECALL = 0.6
RUNS = math.ceil(math.log(1 - TARGET_RECALL) / math.log(1 - RUN_RECALL))
#: Signatures that agree less are no candidates: six standard deviations below the threshold.
SKETCH_MARGIN = 6 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / PLACES)

_MIXERS = ta.seeds(WORDS, salt=1)
_ROWS = ta.seeds(PLACES, salt=2).astype(np.uint32) | np.uint32(1)
_SHIFTS = ta.seeds(PLACES, salt=3).astype(np.uint32)
_SPREAD = ta.seeds(4, salt=4)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted different shingle hashes of each text."""
    for _, data, cuts in ta.chunks(column):
        starts, ends, first = ta.words(data, cuts)
        hashes = ta.hash_spans(data, starts, ends)
        n = len(hashes) - WORDS + 1
        if n > 0:
            held = np.zeros(n, dtype=np.uint64)
            for k in range(WORDS):
                held += hashes[k: k + n] * _MIXERS[k]
            held = ta.mix(held)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= WORDS:
                yield np.unique(held[a: b - WORDS + 1])
            elif b > a:
                short = (hashes[a:b] * _MIXERS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield ta.mix(np.array([short], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minhash values of a set."""
    least = np.full(PLACES, np.iinfo(np.uint32).max, dtype=np.uint32)
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), 1024):
        part = high[at: at + 1024, None] * _ROWS
        part += _SHIFTS
        np.minimum(least, part.min(axis=0), out=least)
    return least


def _identity(shingles: np.ndarray) -> int:
    return int(ta.mix(shingles).sum(dtype=np.uint64).view(np.int64))


def _long(values) -> pa.Array:
    return pa.array(values, pa.int64())


def _sets(docs: DataFrame, key: str, text: str, whole: bool) -> DataFrame:
    """Key, ``which`` (hash of the text), ``node`` (which set it is), ``n``, and the signature or the ``whole`` set."""
    schema = T.StructType([T.StructField("_key", docs.schema[key].dataType), T.StructField("which", T.LongType()), T.StructField("node", T.LongType()),
                           T.StructField("n", T.LongType()), T.StructField("held", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                nodes, sizes, held = [], [], []
                for shingles in shingle_sets(part.column(2)):
                    nodes.append(_identity(shingles))
                    sizes.append(len(shingles))
                    held.append((shingles if whole else signature(shingles)).tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _long(nodes), _long(sizes), pa.array(held, pa.binary())],
                                                 ["_key", "which", "node", "n", "held"])

    return docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("which"), F.col(text)).mapInArrow(run, schema)


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1)


def _child(path: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
    return ta.mix(path * _SPREAD[0] + place.astype(np.uint64) * _SPREAD[1] + value.astype(np.uint64) * _SPREAD[2])


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Children of rows (path, parent's size, node, signature): one place of each path, sometimes a second."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column(0).to_numpy().view(np.uint64)
        signs = _matrix(batch.column(3), np.uint32)
        drawn = ta.mix(path ^ _SPREAD[3])
        one = (drawn % np.uint64(PLACES)).astype(np.int64)
        two = (one + 1 + ((drawn >> np.uint64(20)) % np.uint64(PLACES - 1)).astype(np.int64)) % PLACES
        second = np.flatnonzero((drawn >> np.uint64(40)) % np.uint64(1 << 20) < (1 / THRESHOLD - 1) * (1 << 20))
        rows = np.concatenate([np.arange(len(path)), second])
        places = np.concatenate([one, two[second]])
        buckets = _child(path[rows], places, signs[rows, places]).view(np.int64)
        picked = pa.array(rows)
        yield pa.RecordBatch.from_arrays([_long(buckets), batch.column(1).take(picked), batch.column(2).take(picked)],
                                         ["bucket", "parent", "node"])


def leaves(classes: DataFrame) -> DataFrame:
    """Buckets to be compared: (bucket, size, node), each with two classes or more."""
    roots = F.array(*[F.lit(int(ta.mix(ta.seeds(1, salt=100 + r))[0].view(np.int64))) for r in range(RUNS)])
    rows = classes.select(F.explode(roots).alias("path"), F.lit(0).cast("long").alias("parent"), "node", F.col("held").alias("signature"))
    done = None
    for level in range(1, DEPTH + 1):
        children = cut_lineage(rows.mapInArrow(_split, "bucket long, parent long, node long"), f"paths-{level}")
        sizes = children.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        level_rows = cut_lineage(children.join(sizes, "bucket"), f"buckets-{level}")
        final = (F.col("size") <= BLOCK) | ((F.col("parent") > 0) & (F.col("size") >= STALLED * F.col("parent")))
        ends = level_rows if level == DEPTH else level_rows.where(final)
        ends = ends.select("bucket", "size", "node")
        done = ends if done is None else done.unionByName(ends)
        large = level_rows.where(~final)
        if level == DEPTH or large.isEmpty():
            break
        rows = large.join(classes.select("node", F.col("held").alias("signature")), "node") \
            .select(F.col("bucket").alias("path"), F.col("size").alias("parent"), "node", "signature")
    return done


def _blocks(found: DataFrame) -> DataFrame:
    """Each row once for every pair of blocks that its block is in."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    return found.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))) \
        .select("bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "node")


def _candidates(table: pa.Table, a: int, b: int, signs: np.ndarray, sizes: np.ndarray, own: np.ndarray,
                spots: np.ndarray, lists: np.ndarray, bucket: int) -> np.ndarray:
    """Pairs (two rows of numbers) of the group's rows that belong to this bucket and look similar."""
    one, two = np.flatnonzero(own[a:b] == own[a:b].min()), np.flatnonzero(own[a:b] == own[a:b].max())
    pairs = []
    held, n = signs[a:b], sizes[a:b]
    for i in one.tolist():
        # within one block each pair counts once, between two blocks all pairs count
        others = two[two > i] if own[a + i] == own[a + two[0]] else two
        if not len(others):
            continue
        near = np.minimum(n[others], n[i]) >= THRESHOLD * np.maximum(n[others], n[i])
        others = others[near]
        others = others[(held[others] == held[i]).mean(axis=1) >= THRESHOLD - SKETCH_MARGIN]
        if len(others):
            pairs.append(np.stack([np.full(len(others), i), others]))
    if not pairs:
        return np.zeros((2, 0), dtype=np.int64)
    found = np.concatenate(pairs, axis=1)
    # the pair is compared in the least bucket that both are in
    low = lists[spots[a]: spots[b]] < bucket
    owners = np.repeat(np.arange(b - a), np.diff(spots[a: b + 1]))[low]
    names, codes = np.unique(lists[spots[a]: spots[b]][low], return_inverse=True)
    if len(names):
        inside = np.zeros((b - a, len(names)), dtype=bool)
        inside[owners, codes] = True
        earlier = np.concatenate([(inside[found[0, k: k + 4096]] & inside[found[1, k: k + 4096]]).any(axis=1)
                                  for k in range(0, found.shape[1], 4096)])
        found = found[:, ~earlier]
    return found


def _columns(table: pa.Table) -> tuple:
    lists = table.column("buckets").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    counts = lists.value_lengths().to_numpy()
    return (_matrix(table.column("sketch"), np.uint8), table.column("n").to_numpy(), table.column("own").to_numpy(),
            np.append(0, np.cumsum(counts)), lists.flatten().to_numpy(), table.column("bucket").to_numpy())


def _with_partner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a candidate in their group."""
    for table, cuts in complete_groups(batches, ("bucket", "one", "two")):
        signs, sizes, own, spots, lists, bucket = _columns(table)
        wanted = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a > 1:
                wanted.append(a + np.unique(_candidates(table, a, b, signs, sizes, own, spots, lists, bucket[a])))
        rows = pa.array(np.concatenate(wanted) if wanted else np.zeros(0, np.int64))
        yield from table.select(["bucket", "one", "two", "own", "node", "n", "sketch", "buckets", "copies"]).take(rows).to_batches()


def _overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Number of shared shingles of each pair."""
    if pairs.shape[1] <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in pairs.T.tolist()])
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    names, codes = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(codes, kind="stable")
    codes, owners = codes[order], owners[order]
    for at in range(0, len(names), 4096):
        low, high = np.searchsorted(codes, [at, at + 4096])
        inside = np.zeros((len(sets), min(4096, len(names) - at)), dtype=np.float32)
        inside[owners[low:high], codes[low:high] - at] = 1
        shared += inside @ inside.T
    return shared[pairs[0], pairs[1]].astype(np.int64)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links of each row within its group: how many documents, and a class that it hangs together with."""
    for table, cuts in complete_groups(batches, ("bucket", "one", "two")):
        signs, sizes, own, spots, lists, bucket = _columns(table)
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        links, roots = np.zeros(len(nodes), dtype=np.int64), nodes.copy()
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            pairs = _candidates(table, a, b, signs, sizes, own, spots, lists, bucket[a]) if b - a > 1 else np.zeros((2, 0), np.int64)
            if not pairs.shape[1]:
                continue
            sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").slice(a, b - a).to_pylist()]
            shared = _overlaps(sets, pairs)
            n = sizes[a:b]
            good = shared >= THRESHOLD * (n[pairs[0]] + n[pairs[1]] - shared) - 1e-9
            i, j = pairs[:, good]
            np.add.at(links, a + i, copies[a + j])
            np.add.at(links, a + j, copies[a + i])
            # the least class that can be reached inside the group
            root = nodes[a:b].copy()
            while True:
                before = root.copy()
                np.minimum.at(root, i, root[j])
                np.minimum.at(root, j, root[i])
                if (before == root).all():
                    break
            roots[a:b] = root
        some = links > 0
        yield pa.RecordBatch.from_arrays([_long(nodes[some]), _long(links[some]), _long(roots[some])], ["node", "links", "root"])


def _grouped(rows: DataFrame) -> DataFrame:
    keys = ("bucket", "one", "two")
    return rows.repartition(*keys).sortWithinPartitions(*keys, "node")


def _classes(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and ``root`` and links of each node."""
    sets = cut_lineage(_sets(docs, key, text, whole=False), "signatures")
    classes = cut_lineage(sets.where("n > 0").groupBy("node", "n").agg(
        F.min("_key").alias("least"), F.min(F.struct("which", "_key")).alias("one"), F.count(F.lit(1)).alias("copies"), F.first("held").alias("held")), "classes")
    found = cut_lineage(leaves(classes.select("node", "held")), "leaves")
    lists = found.groupBy("node").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
    # one byte of each minhash value is enough to find candidates
    sketched = classes.join(lists, "node").mapInArrow(_sketches, "node long, n long, copies long, sketch binary, buckets array<long>")
    near = cut_lineage(_grouped(_blocks(found).join(sketched, "node")).mapInArrow(
        _with_partner, "bucket long, one int, two int, own int, node long, n long, sketch binary, buckets array<long>, copies long"),
        "candidates")
    # the whole sets of classes that have candidates, from one text under one key of each, which may be null
    wanted = near.select("node").distinct().join(classes, "node") \
        .select(F.col("one.which").alias("_which"), F.col("one._key").alias("_of")).distinct()
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("_hash")) \
        .join(wanted, (F.col("_hash") == F.col("_which")) & F.col("_key").eqNullSafe(F.col("_of")), "left_semi")
    whole = _sets(texts, "_key", "_text", whole=True).select("node", F.col("held").alias("shingles")).dropDuplicates(["node"])
    compared = cut_lineage(_grouped(near.join(whole, "node")).mapInArrow(_compare, "node long, links long, root long"), "links")
    counts = compared.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(compared.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b"))
    known = cut_lineage(classes.drop("held", "one").join(counts, "node", "left").join(roots, "node", "left")
                        .withColumn("root", F.coalesce("root", "node")), "class-links")
    return sets, known


def links(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, ``class_id`` and ``n_links``."""
    sets, known = _classes(docs, key, text)
    least = known.groupBy("root").agg(F.min("least").alias("class_id"))
    classed = known.join(least, "root").select(
        F.col("node").alias("_node"), "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return sets.select("_key", F.when(F.col("n") > 0, F.col("node")).alias("node")) \
        .join(classed, F.col("node") == F.col("_node"), "left") \
        .select(F.col("_key").alias(key), F.coalesce("class_id", F.col("_key")).alias("class_id"),
                F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = batch.column(batch.schema.get_field_index("held")).to_pylist()
        sketches = [(np.frombuffer(h, dtype=np.uint32) >> np.uint32(24)).astype(np.uint8).tobytes() for h in held]
        columns = {name: batch.column(batch.schema.get_field_index(name)) for name in ("node", "n", "copies", "buckets")}
        yield pa.RecordBatch.from_arrays([columns["node"], columns["n"], columns["copies"], pa.array(sketches, pa.binary()),
                                          columns["buckets"]], ["node", "n", "copies", "sketch", "buckets"])


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with all its columns: the one of least key, a row without a key where no row has one.

    Rows of one key and text count as one document, blank ones too; blank rows without a key all stay. Extra columns may
    have any names.
    """
    names = docs.columns
    places = [f"_c{i}" for i in range(len(names))]
    docs, key, text = docs.toDF(*places), places[names.index(key)], places[names.index(text)]
    sets, known = _classes(docs, key, text)
    rows = sets.groupBy("_key", "which", F.when(F.col("n") > 0, F.col("node")).alias("node")).agg(F.count(F.lit(1)).alias("_rows"))
    own = F.struct(F.col("_key").isNull().alias("bare"), F.col("_key"), F.col("which"), F.col("_rows"))
    best = rows.where("node is not null").groupBy("node").agg(F.min(own).alias("best")) \
        .join(known.select("node", "root"), "node").groupBy("root").agg(F.min("best").alias("best")).select("best.*")
    blank = rows.where("node is null").select("_key", "which", F.when(F.col("_key").isNull(), 1).otherwise(F.col("_rows")).alias("_rows"))
    counted = cut_lineage(best.drop("bare").unionByName(blank).select(
        F.col("_key").alias("_kept"), F.col("which").alias("_kept_text"), "_rows"), "kept")
    same = F.col(key).eqNullSafe(F.col("_kept")) & (F.xxhash64(text) == F.col("_kept_text"))
    single = docs.join(counted.where("_rows = 1"), same, "left_semi")
    several = docs.join(counted.where("_rows > 1"), same, "left_semi").dropDuplicates([key, text])
    return single.unionByName(several).toDF(*names)
