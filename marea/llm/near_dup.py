"""Embedding near-duplicates by a random-projection tree forest.

Vectors are compared only within their label (and length). Equal vectors are one
node. A forest parts the members of a group that is larger than a leaf, so such groups
are taken out first, exactly: a cell is a centre with a radius, its members inside link
with nothing farther out than radius + acos(threshold). A cell is cut into rings by the
angle to the centre. Two rings whose angles add up to less than acos(threshold) are
linked throughout and need only their counts, two rings farther apart than that not at
all; any other two are compared in full, by one task. Labels of a few leaves, and those
where a forest would cost more than that, are one cell each.

Of the nodes outside of cells, every tree splits the nodes of a label at the median of a random projection,
again and again, and rows near a median go to both sides (spill), until leaves are
small. All pairs within a leaf are compared in double precision; a pair that meets in
several leaves counts in the one with the smallest number. A leaf gives one row per
member, its number of links and the smallest member of its group there, never its pairs.

The splits are fitted on at most ``sample`` rows a round and then applied to every
row; leaves that are still too large form the roots of the next round. Trees are drawn
until few of the linked pairs among the sampled rows are missed, and as many as the depth
calls for at least. Groups of fewer than eight sampled rows are left to the forest.

Defined cases: a vector that is null, empty, zero, or holds a null or a non-finite
component, a null label, and a null id link with nothing; the component of a null id
is null. Rows that repeat an id are vectors of their own. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from marea.llm.common import KEY_BITS, column, hash_key
from marea.llm.components import components
from marea.session import materialized

THRESHOLD = 0.93
LEAF = 1024
SPILL = 0.05            # share of a node's rows on each side of the median that go both ways
SAMPLE = 100_000
SAMPLE_BYTES = 64 * 1024 * 1024
MIN_TREES = 8
STAY, MISS = 0.92, 0.01     # a close pair stays together per level at least so often; pairs missed at most
EXACT = 8               # labels of up to so many leaves are compared in full
RING = 4096             # rows of a ring, about
PROBES, PAIRS = 500, 2000   # sampled rows whose links are all known, and the pairs of them that are followed
SLACK = 1e-6            # of angles, which are less precise than cosines


def signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def name_of(*parts) -> int:
    return signed(xxhash.xxh64_intdigest("|".join(map(str, parts))))


def trees_for(rows: int, leaf: int = LEAF, least: int = MIN_TREES) -> int:
    levels = max(0.0, math.log(max(rows, 1) / leaf) / -math.log(0.5 + SPILL))
    together = STAY ** levels
    return least if together > 0.999 else max(least, math.ceil(math.log(MISS) / math.log(1 - together)))


def read_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (vec_id, embedding, label) to (vec_id, set_key, root, unit), the last
    three null for vectors that link with nothing."""
    for batch in batches:
        vec_ids, lists, labels = batch.columns
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)    # a null becomes NaN
        widths = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        starts = np.cumsum(widths) - widths
        known = (vec_ids.is_valid().to_numpy(zero_copy_only=False) & labels.is_valid().to_numpy(zero_copy_only=False)
                 & (widths > 0))
        names, found = labels.to_pylist(), [(None, None, None)] * batch.num_rows
        for width in np.unique(widths[known]):
            rows = np.flatnonzero(known & (widths == width))
            vectors = flat[starts[rows, None] + np.arange(width)]
            good = np.isfinite(vectors).all(1) & vectors.any(1)
            rows, vectors = rows[good], vectors[good]
            vectors = vectors / np.abs(vectors).max(1, keepdims=True)   # neither overflow nor underflow in the norm
            units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            for row, vector, unit in zip(rows, vectors, units):
                root = name_of("root", names[row], width)
                key = signed(xxhash.xxh64_intdigest(vector.tobytes(), seed=root % (1 << 64)))
                found[row] = (key, root, unit.tobytes())
        keys, roots, blobs = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [vec_ids, pa.array(keys, pa.int64()), pa.array(roots, pa.int64()), pa.array(blobs, pa.binary())],
            names=["vec_id", "node", "root", "unit"])


@dataclass
class Tree:
    """Split nodes in order of creation. A row goes to ``left`` up to ``high`` and to
    ``right`` from ``low`` on; negative children are leaves, numbered -1, -2, ..."""

    seed: int
    depth: int = 0
    level: list[int] = field(default_factory=list)
    low: list[float] = field(default_factory=list)
    high: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    leaves: list[int] = field(default_factory=list)

    def lines(self, units: np.ndarray, depth: int) -> np.ndarray:
        """Each row along the direction of each level; a deeper tree adds directions."""
        drawn = np.random.default_rng(self.seed % (1 << 63)).normal(size=(depth, units.shape[1]))
        return units @ drawn.T

    def add_leaf(self) -> int:
        self.leaves.append(name_of("leaf", self.seed, len(self.leaves)))
        return -len(self.leaves)


def grow(units: np.ndarray, seed: int, leaf: float, spill: float) -> Tree:
    """Split the sampled rows until at most ``leaf`` of them are together."""
    tree = Tree(seed)
    most = max(1, 4 * math.ceil(math.log2(max(2.0, len(units) / leaf))))
    lines = tree.lines(units, most)

    def split(members: np.ndarray, level: int) -> int:
        if len(members) <= leaf or level == most:
            return tree.add_leaf()
        along = lines[members, level]
        low, high = np.quantile(along, [0.5 - spill, 0.5 + spill])
        sides = members[along <= high], members[along >= low]
        if max(map(len, sides)) == len(members):
            return tree.add_leaf()
        here = len(tree.level)
        tree.depth = max(tree.depth, level + 1)
        for values, value in zip((tree.level, tree.low, tree.high, tree.left, tree.right), (level, low, high, 0, 0)):
            values.append(value)
        tree.left[here] = split(sides[0], level + 1)
        tree.right[here] = split(sides[1], level + 1)
        return here

    split(np.arange(len(units)), 0)
    return tree


def route(tree: Tree, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf name) for every leaf that a row falls into."""
    rows, at = np.arange(len(units)), np.zeros(len(units), np.int64)
    names = np.array(tree.leaves, np.int64)
    if not tree.level:
        return rows, np.repeat(names[:1], len(rows))
    lines = tree.lines(units, tree.depth)
    level, low, high, left, right = (np.array(v) for v in (tree.level, tree.low, tree.high, tree.left, tree.right))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(rows):
        along = lines[rows, level[at]]
        to_left, to_right = along <= high[at], along >= low[at]
        rows, at = (np.concatenate((rows[to_left], rows[to_right])),
                    np.concatenate((left[at[to_left]], right[at[to_right]])))
        done.append((rows[at < 0], names[-at[at < 0] - 1]))
        rows, at = rows[at >= 0], at[at >= 0]
    return tuple(np.concatenate(parts) for parts in zip(*done))


def assign(forest: dict[int, list[Tree]]):
    """Task function: (node, copies, unit, leaves) with the leaves that are roots in the
    forest replaced by the leaves of their trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("unit").to_pylist()
            old = batch.column("leaves").to_pylist()
            fresh_leaves = [[leaf for leaf in leaves if leaf not in forest] for leaves in old]
            waiting: dict[int, list[int]] = {}
            for row, leaves in enumerate(old):
                for leaf in leaves:
                    if leaf in forest:
                        waiting.setdefault(leaf, []).append(row)
            for root, members in waiting.items():
                units = np.stack([np.frombuffer(blobs[m], np.float64) for m in members])
                for tree in forest[root]:
                    for row, leaf in zip(*(v.tolist() for v in route(tree, units))):
                        fresh_leaves[members[row]].append(leaf)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), batch.column("unit"),
                 pa.array(fresh_leaves, pa.list_(pa.int64()))], names=["node", "copies", "unit", "leaves"])

    return run


@dataclass
class Cell:
    """Ring r holds the angles to ``centre`` above cuts[r] and up to cuts[r + 1]; the first
    ``inner`` rings are inside."""

    centre: np.ndarray
    cuts: np.ndarray
    inner: int

    def rings(self, units: np.ndarray) -> np.ndarray:
        """The ring of each row; as many as there are rings where it lies outside of all."""
        return np.searchsorted(self.cuts[1:], angles(units, self.centre))

    def relation(self, i: int, j: int, reach: float) -> str:
        i, j = min(i, j), max(i, j)
        if i >= self.inner:
            return "outside"
        if self.cuts[i + 1] + self.cuts[j + 1] <= reach - SLACK:
            return "linked"
        return "apart" if self.cuts[j] - self.cuts[i + 1] > reach + SLACK else "compared"


def angles(units: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centre, -1, 1))


def cell_of(units: np.ndarray, scale: float, centre: np.ndarray, radius: float, reach: float) -> Cell:
    """Rings of about RING rows each, if a row of ``units`` stands for ``scale`` rows."""
    at, edge = angles(units, centre), min(4.0, radius + reach + SLACK)
    cuts = [0.0, radius, edge] + ([reach / 2 - SLACK] if reach / 2 < radius else [])
    for some in (at[at <= radius], at[(at > radius) & (at <= edge)]):
        parts = math.ceil(len(some) * scale / RING)
        cuts += np.quantile(some, np.arange(1, parts) / parts).tolist() if parts > 1 else []
    cuts = np.unique(cuts)
    return Cell(centre, cuts, int(np.searchsorted(cuts, radius)))


def centre_of(units: np.ndarray) -> np.ndarray:
    total = units.sum(0)
    size = np.linalg.norm(total)
    return total / size if size > 0 else units[0]


def dense_cells(units: np.ndarray, rows: int, root: int, leaf: int, spill: float,
                threshold: float) -> tuple[list[Cell], np.ndarray]:
    """Cells around the groups that would fill a good part of a leaf, and the sampled rows
    inside none of them."""
    scale, reach = rows / len(units), math.acos(threshold)
    names = route(grow(units, name_of("dense", root), max(256, leaf / scale), spill), units)
    near = np.zeros(len(units), np.int64)
    order = np.argsort(names[1], kind="stable")
    for members in np.split(names[0][order], np.flatnonzero(np.diff(names[1][order])) + 1):
        for first in range(0, len(members), 1024):
            some = members[first:first + 1024]
            near[some] = np.maximum(near[some], (units[some] @ units[members].T >= threshold).sum(1) - 1)
    least = max(8, leaf / 4 / scale)
    open_, left, cells = near >= least, np.ones(len(units), bool), []
    while open_.any():
        picked = np.argmax(np.where(open_, near, -1))
        close = units @ units[picked] >= threshold
        close[picked] = True
        centre = centre_of(units[close])
        at = angles(units, centre)
        radius = max(reach / 2, at[close & open_].max()) + SLACK
        cells.append(cell_of(units[left], scale, centre, radius, reach))
        open_ &= at > radius
        left &= at > radius
    return cells, left


def sampled_pairs(units: np.ndarray, root: int, threshold: float) -> np.ndarray:
    """Links of some of the rows, an unbiased choice."""
    rng = np.random.default_rng(root % (1 << 63))
    probes = rng.permutation(len(units))[:PROBES]
    found = []
    for first in range(0, len(probes), 50):
        some = probes[first:first + 50]
        a, b = np.nonzero(units[some] @ units.T >= threshold)
        found.append(np.stack((some[a], b), 1))
    pairs = np.concatenate(found)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pairs[rng.permutation(len(pairs))[:PAIRS]]


def together(tree: Tree, units: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Which pairs share a leaf."""
    involved, place = np.unique(pairs, return_inverse=True)
    held: list[set] = [set() for _ in involved]
    for row, leaf in zip(*(v.tolist() for v in route(tree, units[involved]))):
        held[row].add(leaf)
    return np.array([not held[a].isdisjoint(held[b]) for a, b in place.reshape(pairs.shape)], bool)


def fitted(units: np.ndarray, rows: int, root: int, trees: int | None, least: int, leaf: int, spill: float,
           threshold: float) -> list[Tree] | None:
    """Trees for a root, or None if comparing all its rows costs less than so many trees."""
    small = max(8, leaf * len(units) / rows)
    if trees:
        return [grow(units, name_of("tree", root, n), small, spill) for n in range(trees)]
    pairs = sampled_pairs(units, root, threshold)
    parted, grown = np.ones(len(pairs), bool), []
    while len(grown) < least or len(pairs) and parted.mean() > MISS:
        if len(grown) * leaf >= rows:
            return None
        grown.append(grow(units, name_of("tree", root, len(grown)), small, spill))
        if len(pairs):
            parted &= ~together(grown[-1], units, pairs)
    return grown


def sampled(nodes: DataFrame, large: DataFrame, sample: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(leaf, rows, units) for the leaves in ``large`` (leaf, rows), from at most about ``sample``
    rows, and fewer of them where vectors are so long that they would take more than SAMPLE_BYTES."""
    total = large.agg(F.sum("rows").alias("n")).first()["n"]
    width = nodes.agg(F.max(F.octet_length("unit")).alias("width")).first()["width"]
    share = min(1.0, min(sample, SAMPLE_BYTES // width) / total)
    rows = nodes.select("node", "unit", F.explode("leaves").alias("leaf")) \
        .where(hash_key(F.col("node"), 1) < int(share * (1 << KEY_BITS))).join(large, "leaf")
    picked: dict[int, list[np.ndarray]] = {}
    sizes: dict[int, int] = {}
    for batch in rows.select("leaf", "rows", "unit").toArrow().to_batches():
        for root, count, unit in zip(*(c.to_pylist() for c in batch.columns)):
            picked.setdefault(root, []).append(np.frombuffer(unit, np.float64))
            sizes[root] = count
    for root in list(picked):
        yield root, sizes[root], np.stack(picked.pop(root))


def fit_cells(nodes: DataFrame, large: DataFrame, trees: int | None, leaf: int, spill: float, sample: int,
              threshold: float) -> tuple[dict[int, list[Cell]], dict[int, list[Tree]]]:
    """The cells of each large root, and the trees for what they leave."""
    cells, forest, reach = {}, {}, math.acos(threshold)
    for root, rows, units in sampled(nodes, large, sample):
        whole = trees is None and rows <= EXACT * leaf
        if not whole:
            cells[root], left = dense_cells(units, rows, root, leaf, spill, threshold)
            rest = round(rows * left.mean())
            if rest > leaf:
                grown = fitted(units[left], rest, root, trees, trees_for(rest, leaf), leaf, spill, threshold)
                whole = grown is None
                forest[root] = grown or []
        if whole:
            cells[root] = [cell_of(units, rows / len(units), centre_of(units), math.pi, reach)]
            forest.pop(root, None)
    return {root: found for root, found in cells.items() if found}, forest


def fit_round(nodes: DataFrame, large: DataFrame, trees: int | None, leaf: int, spill: float, sample: int,
              threshold: float) -> dict[int, list[Tree]]:
    """Trees for the leaves in ``large``, but for those that are better compared as they are."""
    forest = {}
    for root, rows, units in sampled(nodes, large, sample):
        grown = fitted(units, rows, root, trees, trees_for(rows, leaf, 1), leaf, spill, threshold)
        if grown and any(t.level for t in grown):
            forest[root] = grown
    return forest


def put_in_cells(cells: dict[int, list[Cell]]):
    """Task function: (node, copies, unit, leaves) with the cells (root, number, ring) that hold
    the node, up to the first that has it inside; such a node leaves the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs, old = batch.column("unit").to_pylist(), batch.column("leaves").to_pylist()
            held: list[list[dict]] = [[] for _ in old]
            waiting: dict[int, list[int]] = {}
            for row, (root,) in enumerate(old):
                if root in cells:
                    waiting.setdefault(root, []).append(row)
            for root, members in waiting.items():
                members = np.array(members)
                units = np.stack([np.frombuffer(blobs[m], np.float64) for m in members])
                for number, cell in enumerate(cells[root]):
                    rings = cell.rings(units)
                    for n in np.flatnonzero(rings < len(cell.cuts) - 1):
                        held[members[n]].append({"root": root, "number": number, "ring": int(rings[n])})
                    inside = rings < cell.inner
                    for row in members[inside]:
                        old[row] = []
                    members, units = members[~inside], units[~inside]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), batch.column("unit"), pa.array(old, pa.list_(pa.int64())),
                 pa.array(held, pa.list_(pa.struct([("root", pa.int64()), ("number", pa.int32()), ("ring", pa.int32())])))],
                names=["node", "copies", "unit", "leaves", "cells"])

    return run


def compare_rings(threshold: float):
    """Group function: the members of one or two rings to (node, links, parent)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("node", "ascending")])
        node, ring = table.column("node").to_numpy(), table.column("ring").to_numpy()
        copies = table.column("copies").to_numpy().astype(np.float64)
        units = np.stack([np.frombuffer(u, np.float64) for u in table.column("unit").to_pylist()])
        one = np.flatnonzero(ring == ring.min())
        two = np.flatnonzero(ring == ring.max())
        same = len(one) == len(node)
        if same and key[1].as_py():     # the other ring has no rows
            one, two = one[:0], two[:0]
        close = np.zeros((len(one), len(two)), bool)
        for first in range(0, len(one), 1024):
            close[first:first + 1024] = units[one[first:first + 1024]] @ units[two].T >= threshold
        if same:
            np.fill_diagonal(close, False)
        links = np.zeros(len(node))
        for first in range(0, len(one), 1024):
            some = close[first:first + 1024]
            links[one[first:first + 1024]] += some @ copies[two]
            if not same:
                links[two] += copies[one[first:first + 1024]] @ some
        parent, last = np.arange(len(node)), None
        while last is None or (parent != last).any():
            last = parent.copy()
            for first in range(0, len(one), 256):
                some, rows = close[first:first + 256], one[first:first + 256]
                if some.any():
                    parent[rows] = np.minimum(parent[rows], np.where(some, parent[two], len(node)).min(1))
                    parent[two] = np.minimum(parent[two], np.where(some, parent[rows][:, None], len(node)).min(0))
            parent = parent[parent]
        linked = links > 0
        return pa.table({"node": node[linked], "links": links[linked].astype(np.int64), "parent": node[parent[linked]]})

    return run


def links_of_cells(held: DataFrame, cells: dict[int, list[Cell]], threshold: float) -> list[DataFrame]:
    """Frames (node, links, parent) of all pairs with a member inside a cell. ``held`` has a row
    per node and cell; a row per ring reaches the driver."""
    reach = math.acos(threshold)
    totals: dict[tuple[int, int], dict[int, tuple[int, int]]] = {}
    for r in held.groupBy("root", "number", "ring").agg(F.sum("copies").alias("n"), F.min("node").alias("node")).collect():
        totals.setdefault((r["root"], r["number"]), {})[r["ring"]] = (r["n"], r["node"])
    sure, tasks = [], []
    for (root, number), rings in totals.items():
        cell = cells[root][number]
        for i in rings:
            related = {j: cell.relation(i, j, reach) for j in rings}
            linked = [j for j in rings if related[j] == "linked"]
            if linked:
                # the smaller the ring, the more it is linked with: the first one links with all of these
                sure.append((root, number, i, sum(rings[j][0] for j in linked), rings[min(linked)][1], i in linked))
            tasks += [(root, number, i, name_of("task", root, number, min(i, j), max(i, j)), i != j)
                      for j in rings if related[j] == "compared"]
    spark, on, frames = held.sparkSession, ["root", "number", "ring"], []
    if sure:
        table = spark.createDataFrame(sure, "root long, number int, ring int, links long, parent long, own boolean")
        frames.append(held.join(F.broadcast(table), on).select(
            "node", (F.col("links") - F.when(F.col("own"), F.col("copies")).otherwise(0)).alias("links"), "parent")
            .where(F.col("links") > 0))
    if tasks:
        table = spark.createDataFrame(tasks, "root long, number int, ring int, task long, two boolean")
        frames.append(held.join(F.broadcast(table), on).select("task", "two", "ring", "node", "copies", "unit")
                      .groupBy("task", "two").applyInArrow(compare_rings(threshold), "node long, links long, parent long"))
    return frames


def compare_leaf(threshold: float):
    """Group function: the members of one leaf to (node, links, parent), for members that
    have a link there. ``links`` counts rows, and only pairs that meet in no leaf before."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        here = key[0].as_py()
        node = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy().astype(np.float64)
        units = np.stack([np.frombuffer(u, np.float64) for u in table.column("unit").to_pylist()])
        lists = table.column("leaves").combine_chunks()
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        member = np.repeat(np.arange(len(node)), np.diff(ends))
        flat = flat[ends[0]:ends[-1]]
        names, number = np.unique(flat[flat < here], return_inverse=True)
        before = np.zeros((len(node), len(names)), np.float32)
        before[member[flat < here], number] = 1
        links, parent = np.zeros(len(node)), np.arange(len(node))
        block = max(64, min(1024, (1 << 23) // len(node)))
        near: list[tuple[np.ndarray, np.ndarray]] = []
        for first in range(0, len(node), block):
            some = slice(first, first + block)
            close = units[some] @ units.T >= threshold
            close[np.arange(close.shape[0]), np.arange(first, first + close.shape[0])] = False
            links[some] = (close & ~(before[some] @ before.T > 0)) @ copies
            a, b = np.nonzero(close)
            near.append((a + first, b))
        a, b = (np.concatenate(v) for v in zip(*near))
        rank = np.argsort(np.argsort(node))     # groups by their smallest node
        parent = rank.copy()
        while True:
            least = parent.copy()
            np.minimum.at(least, a, parent[b])
            if (least == parent).all():
                break
            parent = least
        linked = np.zeros(len(node), bool)
        linked[a] = True
        return pa.table({"node": node[linked], "links": links[linked].astype(np.int64),
                         "parent": np.sort(node)[parent[linked]]})

    return run


CELLS_SCHEMA = "node long, copies long, unit binary, leaves array<bigint>, cells array<struct<root:bigint,number:int,ring:int>>"


def large_leaves(placed: DataFrame, most: int) -> DataFrame:
    """Written table (leaf, rows) of the leaves with more than ``most`` rows."""
    sizes = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("rows"))
    return materialized(sizes.where(F.col("rows") > most))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, trees: int | None = None,
                    leaf: int = LEAF, spill: float = SPILL, sample: int = SAMPLE, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    rows = vectors.select(column(vectors, id_col).cast("long").alias("vec_id"),
                          column(vectors, vector_col).cast("array<double>").alias("embedding"),
                          column(vectors, label_col).cast("string").alias("label"))
    rows = materialized(rows.mapInArrow(read_nodes, "vec_id long, node long, root long, unit binary"))
    nodes = materialized(rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.count("*").alias("copies"), F.any_value("unit").alias("unit"), F.array(F.any_value("root")).alias("leaves"),
        F.min("vec_id").alias("smallest")))
    placed, exact = nodes.select("node", "copies", "unit", "leaves"), []
    large = large_leaves(placed, leaf)
    if not large.isEmpty():
        cells, forest = fit_cells(placed, large, trees, leaf, spill, sample, threshold)
        if cells:
            put = materialized(placed.mapInArrow(put_in_cells(cells), CELLS_SCHEMA))
            held = put.select("node", "copies", "unit", F.explode("cells").alias("cell")) \
                .select("node", "copies", "unit", "cell.root", "cell.number", "cell.ring")
            exact = links_of_cells(held, cells, threshold)
            placed = put.select("node", "copies", "unit", "leaves")
        while True:
            forest = {root: grown for root, grown in forest.items() if any(t.level for t in grown)}
            if forest:
                placed = materialized(placed.mapInArrow(assign(forest), "node long, copies long, unit binary, leaves array<bigint>"))
            large = large_leaves(placed, 2 * leaf)
            if large.isEmpty():
                break
            forest = fit_round(placed, large, 1 if trees else None, leaf, spill, sample, threshold)
            if not forest:
                break       # leaves that no projection splits to advantage are compared in blocks
    leaves = placed.select("node", "copies", "unit", "leaves", F.explode("leaves").alias("leaf"))
    links_found = leaves.groupBy("leaf").applyInArrow(compare_leaf(threshold), "node long, links long, parent long")
    for frame in exact:
        links_found = links_found.unionByName(frame)
    found = materialized(links_found)
    groups = components(found.select(F.col("node").alias("a"), F.col("parent").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = nodes.select("node", "copies", "smallest").join(links, "node", "left") \
        .join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = grouped.groupBy("component").agg(F.min("smallest").alias("component_id"))
    answers = grouped.join(ids, "component").select(
        "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    return rows.select("vec_id", "node").join(answers, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.col("vec_id").isNotNull()).alias("kept"))


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


# All pairs of a label; the forest finds every link where a label fits into one leaf.
OP1_SQL = """
with recursive usable as (
  select vec_id, label, embedding::double[] as v from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and list_dot_product(embedding::double[], embedding::double[]) > 0),
links as (
  select a.vec_id as x, b.vec_id as y from usable a join usable b
    on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
  where list_dot_product(a.v, b.v)
        >= 0.93::double * sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))),
reach as (
  select vec_id as start, vec_id as here from embeddings
  union select start, y from reach join links on here = x),
groups as (select start, min(here) as component_id from reach group by start),
counts as (select x, count(*) as n from links group by x)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, component_id = vec_id as kept
from embeddings join groups on vec_id = start left join counts on vec_id = x
"""
