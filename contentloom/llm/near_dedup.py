"""Near-duplicate documents by an LSH forest over MinHash signatures.

A tree of the forest is an order: all signatures, sorted by the hashes of that tree. Neighbours in an
order have their longest common prefixes with each other. A run of neighbours that agree in the first
hashes is a region; one that holds too many goes deeper, hash by hash, as far as its own crowding
asks. Signatures that a crowded run leaves alone, or still together at the last hash, are candidates
with their nearest neighbours in the order, in windows that overlap.

All orders are one sorted table, cut by ranges wherever rows are many, also inside a run. The sizes
of runs that a cut separates go over it, so depths do not depend on where the cuts are.

In a region the estimated similarities propose links, likeliest first, and every proposed link
between documents that are not connected yet is confirmed on full shingle sets. Documents of crowded
runs are also joined by a prefix filter: of each set the rarest shingles, as many as a similar set
cannot all miss, so that no pair is lost by crowding and shared passages bring nobody together.

Copies are one class from the start: documents with equal sets share a node of the link graph.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from math import ceil, log
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    SPACED,
    Shared,
    Texts,
    Words,
    binaries,
    cut_lineage,
    keyed_only,
    mixed,
    parts_of,
    restored,
    set_aside,
    shingle_sets,
    text_batches,
)
from .graph import components


@dataclass(frozen=True)
class ForestSettings:
    """``percent``: 100 times the least similarity of linked documents.

    Two documents of similarity s agree in the first hashes of an order with probability
    s ** first_depth. There are as many orders as it takes to miss a pair at the threshold once in
    ``missed`` times, 17 for 80 and 12 for 85 percent; crowding does not add to that. ``crowd`` is the
    most documents a region may hold before it goes deeper; it bounds the work per region and drops
    nobody (see ``_regions`` and ``_postings``). Documents of a crowded run that share a rare shingle
    with more than ``crowd`` others are compared by blocks of about ``block``. ``slack`` is how far, in
    standard deviations, an estimate may fall below the threshold and still be confirmed. ``per_part``:
    rows of the orders in a task.
    """

    words: int = 5
    percent: int = 80
    missed: int = 7000
    first_depth: int = 4
    last_depth: int = 8
    crowd: int = 200
    block: int = 1000
    slack: float = 4.0
    per_part: int = 400_000
    seed: int = 11

    @property
    def trees(self) -> int:
        apart = 1 - (self.percent / 100) ** self.first_depth
        return ceil(log(self.missed) / -log(apart)) if apart > 0 else 1

    @property
    def hashes(self) -> int:
        return self.trees * self.last_depth

    @property
    def least_equal(self) -> int:
        """Equal signature hashes from which a pair is confirmed."""
        s, n = self.percent / 100, self.hashes
        return max(1, int(n * s - self.slack * (n * s * (1 - s)) ** 0.5))


def _factors(settings: ForestSettings) -> np.ndarray:
    random = np.random.Generator(np.random.PCG64(settings.seed))
    return random.integers(0, 1 << 63, settings.hashes, np.uint64) * np.uint64(2) + np.uint64(1)


def _signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """16 bits of the least of each hash over the set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        part = shingles[i : i + 512, None] * factors
        np.minimum(least, part.min(axis=0), out=least)
    return (mixed(least) >> np.uint64(48)).astype(np.uint16)


def _name(shingles: np.ndarray) -> np.ndarray:
    """128 bits that two sets share only if they are equal."""
    a = mixed(shingles + np.uint64(0x51)).sum(dtype=np.uint64)
    b = mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return np.array([a, b], np.uint64)


def signatures(docs: DataFrame, settings: ForestSettings) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set, sig) per row; set and sig are NULL for empty sets.

    ``set`` names the shingle set by 128 bits.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(settings)
        null = pa.scalar(None, pa.binary())
        for batch, texts in text_batches(batches, "text"):
            sets = list(shingle_sets(Words(texts, SPACED), settings.words))
            empty = pa.array([not len(s) for s in sets])
            names = binaries(np.array([_name(s) for s in sets], np.uint64))
            sigs = binaries(np.array([_signature(s, factors) for s in sets], np.uint16))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_hash": batch.column("text_hash"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set": pc.if_else(empty, null, names),
                    "sig": pc.if_else(empty, null, sigs),
                }
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, f"doc_id {kind}, text_hash long, n_shingles long, set binary, sig binary"
    )


def common_prefix(trees: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Of each row but the first, how many leading hashes it has in common with the row before."""
    same = (keys[1:] == keys[:-1]) & (trees[1:] == trees[:-1])[:, None]
    return np.logical_and.accumulate(same, axis=1).sum(axis=1)


def run_sizes(prefix: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of its run of neighbours that agree in ``depth`` hashes, and the sizes
    of the runs."""
    run = np.r_[0, np.cumsum(prefix < depth)]
    return run, np.bincount(run)


@dataclass(frozen=True)
class _Edge:
    """The ends of a part of the orders: first and last row, and sizes of the first and the last run at
    each depth."""

    rows: int
    first: tuple[int, bytes]
    last: tuple[int, bytes]
    lead: list[int]
    trail: list[int]


def carried(edges: dict[int, _Edge], depths: range) -> dict[int, tuple[list[int], list[int]]]:
    """For each part, by depth: how many rows before it belong to its first run, and how many behind
    it to its last one."""
    order = sorted(edges)
    before = {p: [0] * len(depths) for p in order}
    behind = {p: [0] * len(depths) for p in order}

    def agree(p: int, q: int) -> int:
        (tree, x), (other, y) = edges[p].last, edges[q].first
        equal = [x[i : i + 2] == y[i : i + 2] for i in range(0, len(x), 2)]
        return 0 if tree != other else (equal + [False]).index(False)

    for p, q in zip(order, order[1:]):
        for k, depth in enumerate(depths):
            if agree(p, q) >= depth:
                whole = edges[p].trail[k] == edges[p].rows
                before[q][k] = edges[p].trail[k] + (before[p][k] if whole else 0)
    for p, q in reversed(list(zip(order, order[1:]))):
        for k, depth in enumerate(depths):
            if agree(p, q) >= depth:
                whole = edges[q].lead[k] == edges[q].rows
                behind[p][k] = edges[q].lead[k] + (behind[q][k] if whole else 0)
    return {p: (before[p], behind[p]) for p in order}


def _named(trees: np.ndarray, keys: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """64 bits that name a prefix of an order."""
    kept = np.where(np.arange(keys.shape[1]) < depth[:, None], keys, 0).astype(np.uint64)
    out = mixed(trees.astype(np.uint64) * np.uint64(64) + depth.astype(np.uint64) + np.uint64(1))
    for column in kept.T:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


def candidates(
    trees: np.ndarray, keys: np.ndarray, before: list[int], behind: list[int], part: int, settings: ForestSettings
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, region) of a sorted part of the orders, and which rows stand in a crowded first run.

    A row is in the region of its run at the least depth at which that holds ``crowd`` rows or fewer.
    Rows that are alone there although their first run is crowded, and rows of runs that are crowded
    at every depth, are in windows of ``crowd`` neighbours that overlap by half.
    """
    s = settings
    prefix = common_prefix(trees, keys)
    depth, size = np.zeros(len(trees), np.int64), np.zeros(len(trees), np.int64)
    wide = np.zeros(len(trees), bool)
    for k, d in enumerate(range(s.first_depth, s.last_depth + 1)):
        run, sizes = run_sizes(prefix, d)
        sizes[0] += before[k]
        sizes[-1] += behind[k]
        own = sizes[run]
        if d == s.first_depth:
            wide = own > s.crowd
        fits = (depth == 0) & (own <= s.crowd)
        depth[fits], size[fits] = d, own[fits]
    regions = np.flatnonzero((depth > 0) & (size > 1))
    left = np.flatnonzero(wide & (size <= 1))
    half = max(1, s.crowd // 2)
    # Windows do not reach from one first run into another.
    run, _ = run_sizes(prefix, s.first_depth)
    starts = np.r_[0, np.flatnonzero(np.diff(run[left])) + 1] if len(left) else np.zeros(0, np.int64)
    place = np.arange(len(left)) - np.repeat(starts, np.diff(np.r_[starts, len(left)])) if len(left) else left
    window = place // half
    base = mixed(run[left].astype(np.uint64) + np.uint64(part << 32) + np.uint64(1 << 62))
    names = [mixed(base + np.uint64(7) * (window + j).astype(np.uint64)) for j in (0, 1)]
    rows = np.r_[regions, left, left]
    found = np.r_[_named(trees[regions], keys[regions], depth[regions]), *names]
    return rows, found.view(np.int64), wide


def _orders(classes: DataFrame, settings: ForestSettings) -> DataFrame:
    """(tree, key, node): every order of the forest, sorted, in parts of bounded size."""
    s = settings
    width = 2 * s.last_depth
    key = F.substring(F.col("sig"), F.col("tree") * width + 1, F.lit(width))
    rows = classes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(s.trees - 1))).alias("tree"))
    rows = rows.select("tree", key.alias("key"), "node")
    parts = parts_of(classes.count() * s.trees, s.per_part)
    order = ["tree", "key", "node"]
    return cut_lineage(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order))


def _part(batches: Iterator[pa.RecordBatch], settings: ForestSettings) -> tuple | None:
    """Trees, keys and nodes of a sorted part, None if it is empty."""
    found = [b for b in batches if b.num_rows]
    if not found:
        return None
    table = pa.Table.from_batches(found).combine_chunks()
    keys = Texts(table.column("key")).data.tobytes()
    keys = np.frombuffer(keys, np.uint16).reshape(-1, settings.last_depth)
    return np.asarray(table.column("tree")), keys, np.asarray(table.column("node"))


def _regions(classes: DataFrame, settings: ForestSettings) -> tuple[DataFrame, DataFrame]:
    """(region, node) of all orders, and the nodes that stand in a crowded first run of some order."""
    s = settings
    orders = _orders(classes, s)
    depths = range(s.first_depth, s.last_depth + 1)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _part(batches, s)
        if found is None:
            return
        trees, keys, _ = found
        prefix = common_prefix(trees, keys)
        sizes = [run_sizes(prefix, d)[1] for d in depths]
        row = {
            "part": TaskContext.get().partitionId(),
            "rows": len(trees),
            "trees": [int(trees[0]), int(trees[-1])],
            "keys": [keys[0].tobytes(), keys[-1].tobytes()],
            "lead": [int(x[0]) for x in sizes],
            "trail": [int(x[-1]) for x in sizes],
        }
        yield pa.RecordBatch.from_pylist([row])

    form = "part long, rows long, trees array<long>, keys array<binary>, lead array<long>, trail array<long>"
    # One row for each part.
    edges = {
        r.part: _Edge(r["rows"], (r.trees[0], bytes(r["keys"][0])), (r.trees[1], bytes(r["keys"][1])), r.lead, r.trail)
        for r in orders.mapInArrow(ends, form).collect()
    }
    over = carried(edges, depths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _part(batches, s)
        if found is None:
            return
        trees, keys, nodes = found
        part = TaskContext.get().partitionId()
        rows, regions, wide = candidates(trees, keys, *over[part], part, s)
        crowded = np.unique(nodes[wide])
        # A crowded node is told once by each part, in a row without a region.
        region = pa.array(np.r_[regions, np.zeros(len(crowded), np.int64)], mask=np.arange(len(rows) + len(crowded)) >= len(rows))
        yield pa.RecordBatch.from_arrays([region, pa.array(np.r_[nodes[rows], crowded])], ["region", "node"])

    found = cut_lineage(orders.mapInArrow(run, "region long, node long"))
    return found.where("region IS NOT NULL"), found.where("region IS NULL").select("node").distinct()


def _groups(regions: DataFrame) -> DataFrame:
    """(group, node) for the distinct member lists of all regions, each of bounded length."""
    lists = (
        regions.groupBy("region")
        .agg(F.array_sort(F.collect_list("node")).alias("members"))
        .where(F.size("members") > 1)
        .select("members")
        .distinct()
    )
    numbered = cut_lineage(lists.withColumn("group", F.monotonically_increasing_id()))
    return numbered.select("group", F.explode("members").alias("node"))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) for a table of (node, doc_id, text_hash).

    Only the wanted texts move. The table goes to every task while it has at most a million rows;
    beyond that Spark joins by shuffle.
    """
    wanted = cut_lineage(wanted)
    small = wanted.count() <= 1_000_000
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = hashed.join(F.broadcast(wanted) if small else wanted, ["doc_id", "text_hash"])
    return found.select("node", "text").dropDuplicates(["node"])


def _connecting(
    nodes: list[int], sigs: np.ndarray, sets: list[np.ndarray], settings: ForestSettings
) -> Iterator[tuple[int, int]]:
    """Confirmed links that connect whatever confirmed links between these nodes can connect."""
    n = len(nodes)
    left, right, equal = [], [], []
    for i in range(n - 1):
        same = (sigs[i + 1 :] == sigs[i]).sum(axis=1)
        likely = np.flatnonzero(same >= settings.least_equal)
        left += [i] * len(likely)
        right += (likely + i + 1).tolist()
        equal += same[likely].tolist()
    root = list(range(n))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for k in sorted(range(len(equal)), key=lambda k: -equal[k]):
        i, j = left[k], right[k]
        if top(i) != top(j) and _similar(sets[i], sets[j], settings.percent):
            root[top(i)] = top(j)
            yield nodes[i], nodes[j]


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _links(members: DataFrame, settings: ForestSettings) -> DataFrame:
    """(a, b) from (group, node, sig, text): links that settle the components inside each group.

    Rows of a group arrive together, so a task holds one group at a time.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch, texts in text_batches(batches, "text"):
            sets = shingle_sets(Words(texts, SPACED), settings.words)
            columns = (batch.column(c).to_pylist() for c in ("group", "node", "sig"))
            yield from zip(*columns, sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for _, group in groupby(rows(batches), itemgetter(0)):
            _, nodes, sigs, sets = zip(*group)
            sigs = np.frombuffer(b"".join(sigs), np.uint16).reshape(len(nodes), -1)
            found += _connecting(nodes, sigs, sets, settings)
        ends = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_pydict({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    return (
        members.repartition("group").sortWithinPartitions("group").mapInArrow(run, "a long, b long")
    )


#: Shingles of a block, for blocks of long texts.
_BLOCK_SHINGLES = 1_000_000


def _blocks(wide: DataFrame, roots: DataFrame, classes: DataFrame, settings: ForestSettings) -> DataFrame:
    """(region, p, q, side, tree, node, root, sig): the two blocks of nodes that a task compares.

    In each region the nodes of its most frequent root are settled among themselves, all others
    are open. Both are dealt to blocks of bounded size, and every pair of blocks of which one is
    open is a task; ``side`` tells the blocks apart. A region of one root makes no task.
    """

    def parts(nodes: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(nodes / settings.block), F.ceil(shingles / _BLOCK_SHINGLES))

    known = classes.select("node", "sig", "n_shingles").join(roots, "node", "left")
    known = known.withColumn("root", F.coalesce("root", "node"))
    placed = cut_lineage(wide.join(known, "node"))
    sizes = placed.groupBy("region", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    split = (
        sizes.groupBy("region")
        .agg(F.max(F.struct("n", "root", "w")).alias("most"), F.sum("n").alias("n"), F.sum("w").alias("w"))
        .where("n > most.n")
        .select(
            "region",
            F.col("most.root").alias("settled"),
            parts(F.col("n") - F.col("most.n"), F.col("w") - F.col("most.w")).alias("opens"),
            parts(F.col("most.n"), F.col("most.w")).alias("others"),
        )
    )
    is_open = F.col("root") != F.col("settled")
    dealt = F.xxhash64("node", F.lit("block"))
    block = F.when(is_open, F.pmod(dealt, F.col("opens"))).otherwise(F.col("opens") + F.pmod(dealt, F.col("others")))
    last = F.when(is_open, F.col("opens") + F.col("others")).otherwise(F.col("opens")) - 1
    facing = F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("facing")
    p = F.least("block", "facing")
    return (
        placed.join(split, "region")
        .select("region", "tree", "node", "root", "sig", block.alias("block"), facing)
        .select(
            "region",
            p.alias("p"),
            F.greatest("block", "facing").alias("q"),
            (F.col("block") != p).cast("int").alias("side"),
            "tree",
            "node",
            "root",
            "sig",
        )
    )


def _likely(
    tree: int, sides: np.ndarray, roots: np.ndarray, sigs: np.ndarray, settings: ForestSettings
) -> dict[int, np.ndarray]:
    """By node index, the later nodes to compare it with: not connected, of the other block if
    there are two, similar by estimate, and not together in the first region of an earlier tree.
    """
    out = {}
    two = sides.any()
    firsts = sigs.reshape(len(sigs), settings.trees, -1)[:, :tree, : settings.first_depth]
    for i in range(len(sigs) - 1):
        equal = (sigs[i + 1 :] == sigs[i]).sum(axis=1)
        likely = (equal >= settings.least_equal) & (roots[i + 1 :] != roots[i])
        if two:
            likely &= sides[i + 1 :] != sides[i]
        found = np.flatnonzero(likely) + i + 1
        if len(found):
            found = found[~(firsts[found] == firsts[i]).all(axis=2).any(axis=1)]
        if len(found):
            out[i] = found
    return out


def _joining(
    likely: dict[int, np.ndarray], roots: np.ndarray, sets: list[np.ndarray], percent: int
) -> Iterator[tuple[int, int]]:
    """Pairs of roots that confirmed links between these nodes connect.

    Nodes of many likely pairs come first: the base of many variants connects them all at once.
    """
    n = len(sets)
    facing: list[list[int]] = [[] for _ in range(n)]
    for i, found in likely.items():
        facing[i] += found.tolist()
        for j in found.tolist():
            facing[j].append(i)
    sizes = np.array([len(s) for s in sets])
    starts = np.r_[0, np.cumsum(sizes)]
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(names), bool)
    root = {r: r for r in roots.tolist()}

    def top(r: int) -> int:
        while root[r] != r:
            root[r] = r = root[root[r]]
        return r

    for i in sorted(range(n), key=lambda k: -len(facing[k])):
        others = [j for j in facing[i] if top(roots[j]) != top(roots[i])]
        if not others:
            continue
        own = flat[starts[i] : starts[i + 1]]
        marked[own] = True
        if 16 * len(others) > n:
            shared = np.add.reduceat(marked[flat], starts[:-1], dtype=np.int64)[others]
        else:
            shared = np.array([marked[flat[starts[j] : starts[j + 1]]].sum() for j in others])
        marked[own] = False
        alike = 100 * shared >= percent * (sizes[i] + sizes[others] - shared)
        for j in np.array(others)[alike].tolist():
            a, b = top(roots[i]), top(roots[j])
            if a != b:
                root[a] = b
                yield int(roots[i]), int(roots[j])


def _separated(
    docs: DataFrame, wide: DataFrame, roots: DataFrame, classes: DataFrame, settings: ForestSettings
) -> DataFrame:
    """(a, b): links between roots, from all open pairs of the lists in ``wide``.

    Signatures are compared first. Texts move only for nodes with a likely partner that is not
    connected yet, once for each block that has one; links are confirmed on full sets.
    """
    task = ["region", "p", "q"]
    columns = [*task, "side", "tree", "node", "root", "sig"]
    kinds = "region long, p long, q long, side int, tree int, node long, root long, sig binary"

    def arrays(group: list[tuple]) -> tuple:
        _, _, _, sides, trees, nodes, own, sigs = zip(*group)
        sigs = np.frombuffer(b"".join(sigs), np.uint16).reshape(len(nodes), -1)
        return trees[0], np.array(sides), np.array(own, np.int64), sigs

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns)))
        for _, group in groupby(rows, itemgetter(0, 1, 2)):
            group = list(group)
            likely = _likely(*arrays(group), settings)
            if likely:
                wanted = np.unique(np.concatenate([[i, *js] for i, js in likely.items()])).tolist()
                values = zip(*(group[i] for i in wanted))
                fields = zip(("long", "long", "long", "int", "int", "long", "long", "binary"), values)
                types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array(v, types[k]) for k, v in fields], columns)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch, texts in text_batches(batches, "text"):
                sets = shingle_sets(Words(texts, SPACED), settings.words)
                yield from zip(zip(*(batch.column(c).to_pylist() for c in columns)), sets)

        found: list[tuple[int, int]] = []
        for _, group in groupby(rows(), lambda row: row[0][:3]):
            group, sets = zip(*group)
            tree, sides, own, sigs = arrays(group)
            likely = _likely(tree, sides, own, sigs, settings)
            found += _joining(likely, own, list(sets), settings.percent)
        ends = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_pydict({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    blocks = _blocks(wide, roots, classes, settings).select(*columns)
    proposed = cut_lineage(blocks.repartition(*task).sortWithinPartitions(*task).mapInArrow(propose, kinds))
    named = classes.select("node", "doc_id", "text_hash")
    texts = _texts(docs, named.join(proposed.select("node").distinct(), "node", "left_semi"))
    members = proposed.join(texts, "node").select(*columns, "text")
    return members.repartition(*task).sortWithinPartitions(*task).mapInArrow(confirm, "a long, b long")


#: Counters of shingles by hash, and those that one row carries.
_COUNTERS, _CARRIED = 1 << 20, 1 << 14


def _shingle_counts(sets: DataFrame) -> np.ndarray:
    """About how many of the sets hold each shingle, by hash: a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_COUNTERS, np.int64)
        for batch in batches:
            data = np.frombuffer(Texts(batch.column("shingles")).data.tobytes(), np.uint64)
            counts += np.bincount((data & np.uint64(_COUNTERS - 1)).astype(np.int64), minlength=_COUNTERS)
        parts = counts.reshape(-1, _CARRIED)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["i", "n"]
        )

    def add(table: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("n"))
        return pa.table({"i": table.column("i")[:1], "n": pa.array([whole.tobytes()], pa.binary())})

    out = np.zeros(_COUNTERS, np.int64)
    for row in sets.mapInArrow(run, "i int, n binary").groupBy("i").applyInArrow(add, "i int, n binary").collect():
        out[row.i * _CARRIED : (row.i + 1) * _CARRIED] = np.frombuffer(row.n, np.int64)
    return np.minimum(out, np.iinfo(np.int32).max).astype(np.int32)


def rarest(shingles: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """So many of a set's rarest shingles that a set of the wanted similarity has one of them among its
    own: a similar set has at least ``percent`` of the shingles, so it cannot miss all of these."""
    kept = len(shingles) - -(-percent * len(shingles) // 100) + 1
    order = np.lexsort((shingles, counts[(shingles & np.uint64(_COUNTERS - 1)).astype(np.int64)]))
    return shingles[order[:kept]]


def _postings(docs: DataFrame, crowded: DataFrame, classes: DataFrame, settings: ForestSettings) -> DataFrame:
    """(region, node): the rarest shingles of the crowded nodes, each with the nodes that have it."""
    named = classes.select("node", "doc_id", "text_hash").join(crowded, "node", "left_semi")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            sets = shingle_sets(Words(texts, SPACED), settings.words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "shingles"]
            )

    sets = cut_lineage(_texts(docs, named).mapInArrow(listed, "node long, shingles binary"))
    shared = Shared(docs.sparkSession, _shingle_counts(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.load()
        for batch in batches:
            texts = Texts(batch.column("shingles"))
            data = texts.data.tobytes()
            own = [
                rarest(np.frombuffer(data[a:b], np.uint64), counts, settings.percent)
                for a, b in zip(texts.bounds[:-1], texts.bounds[1:])
            ]
            nodes = np.repeat(np.asarray(batch.column("node")), [len(x) for x in own])
            found = np.concatenate(own) if own else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(nodes)], ["region", "node"])

    return sets.mapInArrow(run, "region long, node long")


def _moved(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) with links between roots, or nodes without one, as well."""
    joined = components(links)
    joined = cut_lineage(joined.select(F.col("node").alias("old"), F.col("root").alias("new")))
    moved = roots.join(joined, F.col("root") == F.col("old"), "left").select(
        "node", F.coalesce("new", "root").alias("root")
    )
    alone = joined.select(F.col("old").alias("node"), F.col("new").alias("root"))
    return cut_lineage(moved.unionByName(alone.join(roots, "node", "left_anti")))


def _open_lists(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """(region, node, n) of the lists whose nodes are not all connected yet, n of them."""
    known = postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lists = known.groupBy("region").agg(
        F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most")
    )
    return cut_lineage(known.join(lists.where("least < most").select("region", "n"), "region").select("region", "node", "n"))


def _with_crowded(
    docs: DataFrame, roots: DataFrame, crowded: DataFrame, classes: DataFrame, settings: ForestSettings
) -> DataFrame:
    """``roots`` with all links between crowded nodes: those of short lists first, then what is open in
    long ones, block by block."""
    roots = cut_lineage(roots)
    postings = cut_lineage(_postings(docs, crowded, classes, settings))
    lists = _open_lists(postings, roots)
    short = _group_links(docs, lists.where(F.col("n") <= settings.crowd).select("region", "node"), classes, settings)
    top = short.join(roots.withColumnRenamed("node", "a").withColumnRenamed("root", "ra"), "a", "left")
    top = top.join(roots.withColumnRenamed("node", "b").withColumnRenamed("root", "rb"), "b", "left")
    roots = _moved(roots, top.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    long = _open_lists(lists.where(F.col("n") > settings.crowd).select("region", "node"), roots)
    if not long.isEmpty():
        wide = long.select("region", F.lit(0).alias("tree"), "node")
        roots = _moved(roots, _separated(docs, wide, roots, classes, settings))
    return roots


def _group_links(docs: DataFrame, regions: DataFrame, classes: DataFrame, settings: ForestSettings) -> DataFrame:
    """(a, b): confirmed links inside regions of bounded size."""
    members = _groups(regions)
    signed = members.join(classes.select("node", "sig"), "node")
    named = classes.select("node", "doc_id", "text_hash")
    texts = _texts(docs, named.join(members.select("node").distinct(), "node", "left_semi"))
    return _links(signed.join(texts, "node"), settings)


def _judged(docs: DataFrame, settings: ForestSettings) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) per row."""
    marked = cut_lineage(signatures(docs, settings))
    classes = (
        marked.where("set IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
        .select("set", "first.*", "sig", "n_shingles", F.monotonically_increasing_id().alias("node"))
    )
    classes = cut_lineage(classes)
    regions, crowded = _regions(classes, settings)
    roots = components(_group_links(docs, regions, classes, settings))
    crowded = cut_lineage(crowded)
    if not crowded.isEmpty():
        roots = _with_crowded(docs, roots, crowded, classes, settings)

    named = classes.select("set", "node", "doc_id").join(roots, "node", "left")
    named = named.select("set", "doc_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = named.join(least, "root").select("set", "component_id")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        marked.select("doc_id", "text_hash", "n_shingles", "set")
        .join(placed, "set", "left")
        .select("doc_id", "text_hash", "n_shingles", own.alias("component_id"))
    )


def near_duplicates(docs: DataFrame, settings: ForestSettings = ForestSettings()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, more): its set's size, its component, the verdict.

    Columns: doc_id, n_shingles, component_id (the least doc_id linked directly or through
    others, itself included) and kept (doc_id = component_id).

    Words are runs of anything but ASCII white space, A-Z lowered. Texts without words, NULL
    texts among them, have no shingles and stand alone. Rows with a NULL doc_id have a NULL
    component and are kept. Rows that repeat a doc_id are judged each by its own text. Other
    columns are ignored, an empty table gives no rows.
    """
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return _judged(keyed_only(docs), settings).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def one_of_each(docs: DataFrame, settings: ForestSettings = ForestSettings()) -> DataFrame:
    """``docs`` with one row of each component, that of the least doc_id; all columns as they were.

    Rows with a NULL doc_id and texts without words all stay. Where rows share the least doc_id
    and have words, one of them stays. The ids to drop go to every task while there are at most a
    million; beyond that Spark joins by shuffle.
    """
    judged = cut_lineage(_judged(keyed_only(docs), settings).where("doc_id IS NOT NULL AND n_shingles > 0"))
    gone = cut_lineage(judged.where("doc_id != component_id").select("doc_id", "text_hash").distinct())
    gone = F.broadcast(gone) if gone.count() <= 1_000_000 else gone
    repeated = judged.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1")
    repeated = cut_lineage(repeated.select("doc_id"))
    whole = set_aside(docs).withColumn("text_hash", F.xxhash64("text"))
    left = whole.join(gone, ["doc_id", "text_hash"], "left_anti")
    if not repeated.isEmpty():
        words = F.length(F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r"))) > 0
        twice = left.where(words).join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        once = left.where(words).join(repeated, "doc_id", "left_anti").unionByName(left.where(~words))
        left = once.unionByName(twice)
    return restored(left, docs.columns)
