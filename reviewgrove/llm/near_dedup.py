"""Near duplicates by an LSH forest: sorted signature orders, neighbours with long common prefixes, exact confirmation.

1. Every text becomes the set of hashes of its word shingles, and texts with equal sets become one class.
2. A class gets a signature of min-hashes, cut into trees. In every tree the classes that share the first values are a
   region, which is looked at whole, in one task, up to REGION classes. A larger one is cut into pieces, and as long as there are at most
   ORDERS + 1 of them, any two are looked at together. Beyond that a region is crowded and is deepened value by value: its classes
   split into the regions of one value more, and only those that are still crowded go on. Besides, the classes of crowded regions are
   sorted by the values of the tree and then by the rest of the signature, so that the longest common prefixes are
   neighbours, and every class is compared with its neighbours on both sides.
3. Within a region or a run of neighbours the signatures give similarity estimates; classes that may be similar are chained. Chains
   over all trees are families. A deeper region takes pairs apart, so any two classes of a crowded region that are in different families after
   that and whose sizes fit meet in a block of two pieces of the region: no pair that shares the least depth in one tree is lost.
   Without crowded regions none of this is run.
4. The full sets of a family come together and every pair that may reach the threshold is confirmed on them, unless it is
   linked already. Families beyond the limits of a task, in classes or in bytes, are cut into pieces, and up to ORDERS + 1 pieces any two are a
   block, so no pair is left out. Larger families are cut into blocks along several signature orders first; every block
   also gets the most central classes of the family. Any two classes of such a family that this leaves in different groups and
   whose sizes fit then meet in a block of two pieces of the family, so no pair is left out.
5. Components of confirmed links, and of the documents in each class, are the groups.

Defined cases: a text without words (null, empty) has an empty set and is linked with nothing; a shorter text is
one shingle; repeated rows are exact copies; a number that comes with several texts is in the group of each; rows without a document number link with nothing and are kept; an empty
table gives an empty result. Other columns are not looked at; the stage carries them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewgrove.llm.batches import VISIBLE, give_back, mixed, slices, window_hashes, words
from reviewgrove.llm.components import components
from reviewgrove.session import bound_batches, stage

SHINGLE = 5
PERCENT = 80
TREES = 16
# Values of a tree, and how many of them a region shares at least.
LEVELS = 6
LEAST_DEPTH = 3
REGION = 1024
OVERLAP = 16
# What one task confirms at a time: so many classes, and so many shingles of 8 bytes in their sets.
BLOCK = 2048
BLOCK_SHINGLES = 1 << 22
HUBS = 32
ORDERS = 3
# Estimates below the threshold by this much are still confirmed on the sets: four standard errors.
SLACK = 0.16
# Pairs of a block that are looked at as Python numbers at a time.
PAIRS_AT_ONCE = 1 << 14
# Bytes of text that are cut into shingles at a time.
SLICE_BYTES = 1 << 19
# Classes of a block after which a worker gives its freed memory back.
LARGE_BLOCK = 256
BROADCAST_BYTES = 64 << 20
HASHES = TREES * LEVELS
_ROWS = 1 << 12


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    found = words(texts, VISIBLE)
    windows = window_hashes(found.hashes, size)
    for text in range(len(texts)):
        first, last = found.first[text], found.first[text + 1]
        n = int(last - first)
        if n >= size:
            yield np.unique(windows[first : last - size + 1])
        elif n:
            yield window_hashes(found.hashes[first:last], n)
        else:
            yield np.zeros(0, np.uint64)


def multipliers() -> np.ndarray:
    return mixed(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Least value of the set under each hash function; long sets piece by piece."""
    parts = [
        (shingles[at : at + _ROWS, None] * factors).min(axis=0) for at in range(0, len(shingles), _ROWS)
    ]
    return np.minimum.reduce(parts)


def set_id(shingles: np.ndarray, factors: np.ndarray) -> bytes:
    """Tells sets apart: two sums over their hashes, and their size."""
    total = np.array([mixed(shingles).sum(), (shingles * factors[0]).sum()], np.uint64)
    return total.tobytes() + len(shingles).to_bytes(4, "little")


def describe(df: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, set_id, keys, sketch`` per document; keys hash the least prefix of each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers()
        for batch in batches:
            texts = pc.fill_null(batch.column(2), "")
            for first, last in slices(texts, SLICE_BYTES):
                sizes, ids, keys, sketches = [], [], [], []
                for shingles in shingle_sets(texts.slice(first, last - first), size):
                    sizes.append(len(shingles))
                    if not len(shingles):
                        ids.append(None)
                        keys.append([])
                        sketches.append(None)
                        continue
                    ids.append(set_id(shingles, factors))
                    values = signature(shingles, factors)
                    prefixes = mixed(values).reshape(TREES, LEVELS)[:, :LEAST_DEPTH]
                    keys.append(window_keys(prefixes))
                    sketches.append(mixed(values).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.array(sizes, pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "set_id", "keys", "sketch"],
                )
        give_back()

    bound_batches(df.sparkSession)
    text = F.col("text").cast("string")
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, set_id binary, keys array<long>, sketch binary")


def window_keys(prefixes: np.ndarray) -> np.ndarray:
    """One number per tree from its first values and the number of the tree."""
    total = np.arange(1, len(prefixes) + 1, dtype=np.uint64)
    for level in range(prefixes.shape[1]):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + prefixes[:, level])
    return total.view(np.int64)


def agreement(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Share of equal sketch bytes. Eight of them are added up at a time: a byte of the sums is at most HASHES."""
    sums = (many == one).view(np.uint64).sum(axis=1)
    return ((sums * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64) / HASHES


def chains(batches: Iterator[pa.RecordBatch], least: float, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Edges between neighbours of sorted ``key, rep, sketch`` rows whose estimate reaches ``least``.

    Rows of a region come one after another and are taken as a whole. With a ``limit`` they are taken in cuts of at most so many
    rows, and a cut begins with the last rows of the one before.
    """
    key, reps, sketches = None, [], []

    def cut(keep: int) -> pa.RecordBatch | None:
        nonlocal reps, sketches
        edges = []
        if len(reps) > 1:
            matrix = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(reps), HASHES)
            todo = np.arange(len(reps))
            # Grow one chain after another: a class takes all classes that may be similar to it out of the list.
            while len(todo) > 1:
                queue, todo = [int(todo[0])], todo[1:]
                chain = list(queue)
                while queue and len(todo):
                    at = queue.pop()
                    near = agreement(matrix[at], matrix[todo]) >= least
                    found = todo[near]
                    todo = todo[~near]
                    chain += found.tolist()
                    queue += found.tolist()
                # A chain is written as a star, which takes the fewest rounds to put together.
                least_rep = min(reps[i] for i in chain)
                edges += [(reps[i], least_rep) for i in chain if reps[i] != least_rep]
        reps, sketches = reps[len(reps) - keep :] if keep else [], sketches[len(sketches) - keep :] if keep else []
        if not edges:
            return None
        a, b = zip(*edges)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        for own, rep, sketch in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if own != key or len(reps) == limit:
                if (out := cut(0 if own != key else OVERLAP)) is not None:
                    yield out
                key = own
            reps.append(rep)
            sketches.append(sketch)
    if (out := cut(0)) is not None:
        yield out


def pieces(load: Column) -> Column:
    """How many pieces a group is cut into whose classes fill so many blocks: two of them fill one."""
    return F.ceil(load * 2).cast("int")


def in_pairs(load: Column) -> Column:
    """Whether a group of more than one block is cut into so few pieces that any two of them can be a block: a class is in no more
    blocks then than several orders would put it into."""
    return pieces(load) <= ORDERS + 1


def paired(rows: DataFrame, unit: str, load: Column) -> DataFrame:
    """``rows`` with ``block`` and ``side``, once for each block of a class. Any two pieces of a unit are a block, so all its pairs meet.

    The classes of a piece meet on side 0, in the block with the next piece; elsewhere they only meet those of the other piece.
    """
    n_pieces, own, other = F.greatest(pieces(load), F.lit(2)), F.col("_piece"), F.col("_other")
    split = rows.withColumn("_pieces", n_pieces).withColumn("_piece", F.pmod(F.xxhash64("rep"), F.col("_pieces")).cast("int"))
    split = split.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).filter(own != other)
    block = F.xxhash64(unit, F.least(own, other), F.greatest(own, other))
    side = F.when(other == F.pmod(own + 1, F.col("_pieces")), 0).otherwise(own + 1)
    return split.withColumns({"block": block, "side": side}).drop("_pieces", "_piece", "_other")


def crowding() -> Column:
    """How many blocks the classes of a region fill."""
    return F.col("n") / BLOCK


def is_crowded() -> Column:
    """Whether a region of ``n`` classes has too many to be looked at whole, or in pairs of its pieces."""
    return (F.col("n") > REGION) & ~in_pairs(crowding())


def regions_of(classes: DataFrame) -> DataFrame:
    """``key, rep, tree, n``: the regions with more than one class."""
    each = classes.select("rep", F.posexplode("keys").alias("tree", "key"))
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return each.join(shared, "key")


def deepened(crowded: DataFrame) -> DataFrame:
    """``key, rep, sketch`` of the regions that crowded ones split into, each as deep as it has to be to hold up to REGION classes.

    ``crowded`` are rows ``key, rep, tree, sketch``. Level by level the next value of the tree joins the key, and only regions that are still too
    large go on to the next level. What is too large with all values of the tree is left to the sorted order.
    """
    rows, leaves = crowded.select("key", "rep", "tree", "sketch"), []
    for depth in range(LEAST_DEPTH, LEVELS):
        deeper = F.xxhash64("key", F.substring("sketch", F.col("tree") * LEVELS + depth + 1, F.lit(1)))
        rows = rows.withColumn("key", deeper)
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        rows = stage(rows.join(sizes, "key"), "deeper-regions")
        leaves.append(rows.filter(F.col("n") <= REGION).select("key", "rep", "sketch"))
        rows = rows.filter(F.col("n") > REGION).drop("n")
        if not rows.limit(1).count():
            break
    return reduce(DataFrame.unionByName, leaves)


def region_edges(regions: DataFrame, classes: DataFrame, percent: int, has_crowded: bool) -> DataFrame:
    """Edges ``a, b`` between classes that may be similar, from all trees: all that small regions have, and those of a few pieces; of crowded ones those
    within the deeper regions that they split into, and those between neighbours in the sorted order, where common prefixes are longest."""
    rows = regions.join(classes.select("rep", "sketch"), "rep")
    least = percent / 100 - SLACK

    def chained(part: DataFrame, limit: int | None = None) -> DataFrame:
        return part.select("key", "rep", "sketch").mapInArrow(lambda batches: chains(batches, least, limit), "a long, b long")

    small = rows.filter(F.col("n") <= REGION).select("key", "rep", "sketch")
    few = paired(rows.filter((F.col("n") > REGION) & in_pairs(crowding())), "key", crowding())
    small = small.unionByName(few.select(F.col("block").alias("key"), "rep", "sketch"))
    if not has_crowded:
        return chained(small.repartition("key").sortWithinPartitions("key", "rep"))
    crowded = stage(rows.filter(is_crowded()), "crowded-regions")
    whole = small.unionByName(deepened(crowded)).repartition("key").sortWithinPartitions("key", "rep")
    # Sorted by the rest of the tree's own values first, then by all others.
    rest = F.substring("sketch", F.col("tree") * LEVELS + 1 + LEAST_DEPTH, F.lit(HASHES))
    ordered = crowded.withColumn("_order", F.concat(rest, "sketch"))
    ordered = ordered.repartitionByRange("key", "_order", "rep").sortWithinPartitions("key", "_order", "rep")
    return chained(whole).unionByName(chained(ordered, REGION))


def crowded_edges(regions: DataFrame, families: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between classes of a crowded region that may be similar and are in different families."""
    known = families.select(F.col("node").alias("rep"), F.col("component").alias("group"))
    rows = regions.filter(is_crowded()).select(F.col("key").alias("unit"), "rep").join(known, "rep", "left")
    rows = rows.withColumn("group", F.coalesce("group", "rep")).join(classes.select("rep", "sketch", "n_shingles"), "rep")

    def links(table: pa.Table) -> pa.Table:
        columns = (table.column(n).to_pylist() for n in ("rep", "sketch", "group", "side", "n_shingles"))
        return pairs_of(linked(list(zip(*columns)), percent), len(table))

    return meetings(rows, BLOCK, percent).groupBy("block").applyInArrow(links, "a long, b long")


def load(limit: int) -> Column:
    """How many blocks of at most ``limit`` classes and BLOCK_SHINGLES shingles a group of classes fills."""
    return F.greatest(F.count(F.lit(1)) / limit, F.sum("n_shingles") / BLOCK_SHINGLES)


def blocks_of(families: DataFrame, classes: DataFrame) -> tuple[DataFrame, bool]:
    """``rep, sketch, group, block, side``: a family is one block up to BLOCK classes; one of a few pieces has a block for any two of them, and
    larger ones are cut along several orders.

    The place of a class in an order comes from the hash range of its signature values, so no family is sorted
    or counted in one task. Every block of a large family also gets the HUBS classes of the family whose leading
    signature values are the most common ones. What no block holds together is left to ``meetings``. A class is its own
    ``group``, and on side 0 it meets all classes of its block. The second value says whether there is a large family.
    """
    rows = families.withColumnRenamed("node", "rep").join(classes.select("rep", "sketch", "n_shingles"), "rep")
    rows = stage(rows.join(rows.groupBy("component").agg(load(BLOCK).alias("load")), "component"), "families")
    columns = ["rep", "sketch", F.col("rep").alias("group"), "block", "side"]
    few = paired(rows.filter((F.col("load") > 1) & in_pairs(F.col("load"))), "component", F.col("load"))
    small = rows.filter("load <= 1").withColumns({"block": F.col("component"), "side": F.lit(0)}).select(*columns)
    small = small.unionByName(few.select(*columns))
    large = rows.filter((F.col("load") > 1) & ~in_pairs(F.col("load")))
    if not large.limit(1).count():
        return small, False
    n_blocks = pieces(F.col("load"))
    orders = []
    for order in range(ORDERS):
        part = F.substring("sketch", order * LEVELS + 1, LEVELS)
        number = F.pmod(F.xxhash64(F.substring(part, 1, 2)), n_blocks)
        orders.append(large.select("component", "rep", "sketch", "n_shingles", F.lit(order).alias("order"), number.alias("number")))
    placed = orders[0]
    for other in orders[1:]:
        placed = placed.unionByName(other)
    # A value of the signature that most of a family shares could still fill a block: spread over the rest of it.
    counts = placed.groupBy("component", "order", "number").agg(load(BLOCK).alias("size"))
    placed = placed.join(counts, ["component", "order", "number"])
    extra = F.pmod(F.xxhash64("sketch"), F.ceil("size").cast("int"))
    block = F.xxhash64("component", "order", "number", extra)
    placed = placed.select("component", "rep", "sketch", block.alias("block"))
    hubs = _hubs(large)
    meeting = placed.select("component", "block").distinct().join(hubs, "component")
    cut = placed.select("rep", "sketch", "block").unionByName(meeting.select("rep", "sketch", "block"))
    # A central class may come to a block twice; it is taken once there.
    return stage(small.unionByName(cut.withColumn("side", F.lit(0)).select(*columns)), "blocks"), True


def band(percent: int) -> Column:
    """Sets whose sizes fit are in the same band or in neighbouring ones."""
    width = max(math.log(100 / percent), 1e-3) * 1.001
    return F.floor(F.log("n_shingles") / width)


def meetings(rows: DataFrame, limit: int, percent: int) -> DataFrame:
    """``rep, sketch, n_shingles, group, block, side`` from the same columns and ``unit``: any two classes of a unit that are
    in different groups and whose sizes fit meet in a block.

    A unit is cut into pieces of about half of ``limit`` classes, those of its largest group apart, and any two pieces are
    a block unless both are of the largest group. The classes of one piece meet on side 0 of a block of their own; in a
    block of two pieces a class meets those of the other side only.
    """
    per_group = rows.groupBy("unit", "group").agg(F.count(F.lit(1)).alias("k"))
    top = per_group.groupBy("unit").agg(F.max_by("group", F.struct("k", "group")).alias("top"), F.count(F.lit(1)).alias("groups"))
    split = rows.join(top.filter("groups > 1").select("unit", "top"), "unit")
    split = stage(split.withColumns({"inner": F.col("group") == F.col("top"), "band": band(percent)}).drop("top"), "to-meet")
    place = ["unit", "band", "inner"]
    n_pieces = split.groupBy(*place).agg(pieces(load(limit)).alias("pieces"))
    placed = split.join(n_pieces, place).withColumn("piece", F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int"))
    each = n_pieces.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
    one = each.select("unit", *[F.col(name).alias(f"{name}_1") for name in ("band", "inner", "piece")])
    two = each.select("unit", *[F.col(name).alias(f"{name}_2") for name in ("band", "inner", "piece")])
    first, second = F.struct("inner_1", "piece_1"), F.struct("inner_2", "piece_2")
    same_band, next_band = F.col("band_2") == F.col("band_1"), F.col("band_2") == F.col("band_1") + 1
    pairs = one.join(two, "unit").filter(((same_band & (first <= second)) | next_band) & ~(F.col("inner_1") & F.col("inner_2")))
    alone = same_band & (first == second)
    block = F.xxhash64("unit", "band_1", "inner_1", "piece_1", "band_2", "inner_2", "piece_2")
    pairs = pairs.select("*", block.alias("block"), alone.alias("alone"))

    def side(number: int) -> DataFrame:
        own = [F.col(f"{name}_{number}").alias(name) for name in ("band", "inner", "piece")]
        return pairs.select("unit", *own, "block", "alone", F.lit(number).alias("side"))

    sides = side(1).withColumn("side", F.when(F.col("alone"), 0).otherwise(1)).unionByName(side(2).filter("NOT alone"))
    met = placed.join(sides.drop("alone"), [*place, "piece"])
    return met.select("rep", "sketch", "n_shingles", "group", "block", "side")


def remaining_blocks(families: DataFrame, groups: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Blocks for the classes of large families that are not in one group yet."""
    sized = families.withColumnRenamed("node", "rep").join(classes.select("rep", "n_shingles"), "rep")
    large = sized.groupBy("component").agg(load(BLOCK).alias("load"))
    large = large.filter((F.col("load") > 1) & ~in_pairs(F.col("load"))).select("component")
    rows = families.join(large, "component").select(F.col("component").alias("unit"), F.col("node").alias("rep"))
    known = groups.select(F.col("node").alias("rep"), F.col("component").alias("group"))
    rows = rows.join(known, "rep", "left").withColumn("group", F.coalesce("group", "rep"))
    rows = rows.join(classes.select("rep", "sketch", "n_shingles"), "rep")
    return meetings(rows, BLOCK, percent).drop("n_shingles")


def _hubs(large: DataFrame) -> DataFrame:
    """The classes of each family that share most of the commonest leading values, a fixed number of them."""
    firsts = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.substring("sketch", t * LEVELS + 1, F.lit(1)))
    values = large.select("component", "rep", F.posexplode(firsts).alias("tree", "v"))
    common = values.groupBy("component", "tree", "v").agg(F.count(F.lit(1)).alias("k"))
    top = common.groupBy("component", "tree").agg(F.max_by("v", F.struct("k", "v")).alias("top"))
    # One row per family with its commonest values by tree: TREES of them.
    tops = top.groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("tree", "top"))).alias("tops"))
    shared = F.aggregate(
        F.sequence(F.lit(0), F.lit(TREES - 1)), F.lit(0),
        lambda n, t: n + (F.get(F.col("firsts"), t) == F.try_element_at("tops", t)).cast("int"),
    )
    scored = large.select("component", "rep", "sketch", firsts.alias("firsts")).join(tops, "component")
    scored = scored.select("component", "rep", "sketch", shared.alias("score"))
    # Each task keeps its own best first, so the ranking sees a bounded number of rows per task.
    own = Window.partitionBy("component", "_task").orderBy(F.desc("score"), "rep")
    best = scored.withColumn("_task", F.pmod(F.xxhash64("rep"), F.lit(256)))
    best = best.withColumn("_n", F.row_number().over(own)).filter(F.col("_n") <= HUBS)
    ranked = best.withColumn("_n", F.row_number().over(Window.partitionBy("component").orderBy(F.desc("score"), "rep")))
    return ranked.filter(F.col("_n") <= HUBS).select("component", "rep", "sketch")


def linked(
    rows: list[tuple[int, bytes, int, int, int]], percent: int, is_link: Callable[[int, int], bool] | None = None
) -> list[tuple[int, int]]:
    """Links between the classes ``rep, sketch, group, side, n_shingles`` of a block, each class to the first one that it hangs together
    with: pairs whose estimate reaches the threshold less SLACK, the highest first, and for which ``is_link`` holds on their places in ``rows``.

    Classes of one group are linked already, and classes on the same side, other than side 0, do not meet here.
    """
    n = len(rows)
    matrix = np.frombuffer(b"".join(row[1] for row in rows), np.uint8).reshape(n, HASHES)
    groups, sides, sizes = (np.array([row[k] for row in rows]) for k in (2, 3, 4))
    _, at, place = np.unique(groups, return_index=True, return_inverse=True)
    root = at[place].tolist()

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    # A block of near copies has a pair for any two of its classes, so a pair takes nine bytes here: two places and the number of equal values.
    second, equal = [np.zeros(0, np.int32)], [np.zeros(0, np.uint8)]
    for i in range(n - 1):
        fits = 100 * np.minimum(sizes[i + 1 :], sizes[i]) >= percent * np.maximum(sizes[i + 1 :], sizes[i])
        fits &= groups[i + 1 :] != groups[i]
        if sides[i]:
            fits &= sides[i + 1 :] != sides[i]
        share = agreement(matrix[i], matrix[i + 1 :])
        near = np.flatnonzero(fits & (share >= percent / 100 - SLACK))
        second.append((near + i + 1).astype(np.int32))
        equal.append(np.rint(HASHES * share[near]).astype(np.uint8))
    first = np.repeat(np.arange(-1, len(second) - 1, dtype=np.int32), [len(own) for own in second])
    second = np.concatenate(second)
    order = np.argsort(HASHES - np.concatenate(equal), kind="stable")
    links: list[tuple[int, int]] = []
    for at in range(0, len(order), PAIRS_AT_ONCE):
        some = order[at : at + PAIRS_AT_ONCE]
        roots = np.array([find(i) for i in range(n)])
        some = some[roots[first[some]] != roots[second[some]]]
        for i, j in zip(first[some].tolist(), second[some].tolist()):
            a, b = find(i), find(j)
            if a != b and (is_link is None or is_link(i, j)):
                root[max(a, b)] = min(a, b)
                links.append((i, j))
    # Everything that was linked here, as stars.
    touched = sorted({i for pair in links for i in pair})
    return [(rows[i][0], rows[find(i)][0]) for i in touched if find(i) != i]


def pairs_of(found: list[tuple[int, int]], n: int) -> pa.Table:
    """The links of a block of ``n`` classes as a table ``a, b``. After a large block freed memory goes back."""
    if n >= LARGE_BLOCK:
        give_back()
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def confirm(rows: list[tuple[int, bytes, int, int, bytes]], percent: int) -> list[tuple[int, int]]:
    """Links between the classes ``rep, sketch, group, side, shingles`` of a block, confirmed on the full sets.

    Sets are sorted numbers and are compared as they lie in ``shingles``, so none is held in another form.
    """
    rows = sorted(dict((row[0], row) for row in rows).values())
    arrays = [np.frombuffer(row[4], "<u8") for row in rows]

    def is_link(i: int, j: int) -> bool:
        few, many = sorted((arrays[i], arrays[j]), key=len)
        common = int(np.count_nonzero(many.take(np.searchsorted(many, few), mode="clip") == few))
        return 100 * common >= percent * (len(few) + len(many) - common)

    return linked([(*row[:4], len(own)) for row, own in zip(rows, arrays)], percent, is_link)


def confirmed_links(df: DataFrame, blocks: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links of all blocks. Only the sets of classes in blocks are made, each once, and each goes to its blocks.

    A class is found by the number and the hash of one of its texts. Only these few numbers meet the texts; the places of a class, of which a
    central one has very many, are joined to its set afterwards.
    """
    wanted = stage(classes.join(blocks.select("rep").distinct(), "rep", "left_semi").select("rep", "doc_id", "text_hash"), "wanted")
    # Three numbers and a row header.
    small = 48 * wanted.count() <= BROADCAST_BYTES
    text = F.col("text").cast("string")
    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    texts = texts.join(F.broadcast(wanted) if small else wanted, ["doc_id", "text_hash"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for first, last in slices(texts, SLICE_BYTES):
                found = shingle_sets(texts.slice(first, last - first), size)
                shingles = pa.array([s.astype("<u8").tobytes() for s in found], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), shingles], names=["rep", "shingles"])
        give_back()

    made = texts.select("rep", "text").mapInArrow(sets, "rep long, shingles binary")
    rows = blocks.join(made, "rep").select("rep", "sketch", "group", "block", "side", "shingles")

    def links(table: pa.Table) -> pa.Table:
        columns = [table.column(n).to_pylist() for n in ("rep", "sketch", "group", "side")]
        found = confirm(list(zip(*columns, [own.as_buffer() for own in table.column("shingles")])), percent)
        return pairs_of(found, len(table))

    return rows.groupBy("block").applyInArrow(links, "a long, b long")


def grouped(df: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id`` per row of ``doc_id, text``; written."""
    described = stage(describe(df, size), "described")
    known = described.filter("doc_id IS NOT NULL AND set_id IS NOT NULL")
    one = F.min_by(F.struct("doc_id", "text_hash", "n_shingles", "keys", "sketch"), F.struct("doc_id", "text_hash")).alias("one")
    # A class has a number of its own, since one document number may come with several texts.
    classes = stage(known.groupBy("set_id").agg(one).select("set_id", F.xxhash64("set_id").alias("rep"), "one.*"), "classes")
    regions = stage(regions_of(classes), "regions")
    has_crowded = bool(regions.filter(is_crowded()).limit(1).count())
    families = components(region_edges(regions, classes, percent, has_crowded))
    if has_crowded:
        more = stage(crowded_edges(regions, families, classes, percent), "may-be-similar")
        if more.limit(1).count():
            known = families.select(F.col("node").alias("a"), F.col("component").alias("b"))
            families = components(known.unionByName(more))
    blocks, has_large = blocks_of(families, classes)
    groups = components(confirmed_links(df, blocks, classes, size, percent))
    if has_large:
        rest = stage(remaining_blocks(families, groups, classes, percent), "remaining-blocks")
        if rest.limit(1).count():
            known = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
            groups = components(known.unionByName(confirmed_links(df, rest, classes, size, percent)))
    # The smallest document number of every component; each task takes its own smallest first. A class without links has its own.
    numbers = groups.join(classes.select("rep", "doc_id"), F.col("node") == F.col("rep"))
    least = numbers.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = classes.select("set_id", "rep", "doc_id").join(groups.join(least, "component"), F.col("rep") == F.col("node"), "left")
    ids = named.select("set_id", F.coalesce("component_id", "doc_id").alias("component_id"))
    return stage(described.select("doc_id", "text_hash", "n_shingles", "set_id").join(ids, "set_id", "left").drop("set_id"), "near-duplicates")


def near_duplicates(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``doc_id, text``."""
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return grouped(df, size, percent).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_copies(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with its own columns; of repeated rows one stays.

    Rows are told by number and text, so a number that comes with two texts loses only the one that is a copy.
    """
    found = grouped(df, size, percent)
    copy = F.col("doc_id") != F.coalesce("component_id", "doc_id")
    gone = stage(found.filter(copy).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct(), "copies")
    # Copies are named by two numbers alone; while those are few, the texts need not be shuffled.
    gone = F.broadcast(gone) if 48 * gone.count() <= BROADCAST_BYTES else gone
    same = (df["doc_id"].cast("long") == gone["_doc"]) & (F.xxhash64(df["text"].cast("string")) == gone["_hash"])
    kept = df.join(gone, same, "left_anti").select(*df.columns)
    repeated = found.filter(~copy).groupBy("doc_id").count().filter("count > 1")
    return kept.dropDuplicates(["doc_id", "text"]) if repeated.limit(1).count() else kept
