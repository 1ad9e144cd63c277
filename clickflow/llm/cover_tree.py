"""Near-duplicate embeddings by dual traversal of cover trees.

Unit vectors of equal label are links when their cosine is at least ``threshold``, that is
when they lie within the chord distance t = sqrt(2 - 2 * threshold).

The top of each label's tree is fitted on a bounded sample: nested nets whose radii halve
until there are enough centres to split the label into nodes of about ``BLOCK`` vectors
(``TOP_SAMPLE`` vectors in all, shared by the ``TOP_LABELS`` largest labels; other labels,
and nodes that stay large, are split by hash, which costs pruning but no result). Every
vector is then put under its nearest centre and the node's covering radius is measured
over all its vectors. Node pairs with d(a, b) - r_a - r_b > t are pruned; the others meet
in a task each, which builds the lower levels of both trees, again nested nets with
halving radii and measured covering radii, and descends them together, level by level,
pruning by the same bound. Pairs of leaves that survive are compared in double precision,
so the links are exactly those of all pairs.

Equal vectors of a label collapse first by partial aggregation and count with their
multiplicity. A task returns, for each vector with links, their number and one member of
its connected group, never the pairs; groups are joined by connected components.

Memory: a task holds two blocks of at most ``2 * BLOCK`` vectors or so and one matrix of
distances between their centres. Vectors without structure (all far apart) prune nothing,
and then the work is that of all pairs of blocks, in blocks.

Defined results: vectors that are null, zero, empty or hold null or non-finite numbers,
and rows with a null label, link with nothing: ``n_links`` 0, ``component_id`` their own id.
Vectors of different length do not link. Rows that repeat an id are vectors of their own,
which link if equal. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.components import components
from clickflow.llm.shared import written

THRESHOLD = 0.93
BLOCK = 2048
TOP_SAMPLE, TOP_LABELS = 16_384, 256
#: Nets go down to this share of the chord distance; leaves are compared as matrices.
LEAF_SHARE = 0.5
SLACK = 1e-7


def unit_vectors(rows: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """(id, part, v): ``v`` the unit vector's doubles as bytes, null for what cannot link;
    ``part`` the label with the vector's length."""
    source = rows.select(F.col(id_column).alias("id"), F.col(label).cast("string").alias("label"), vector)
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, parts = [], []
            for name, v in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                values = None if v.values is None else v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if name is None or values is None or not len(values) or not np.isfinite(values).all():
                    out.append(None)
                    parts.append(None)
                    continue
                largest = np.abs(values).max()
                unit = values / largest if largest > 0 else values
                norm = np.sqrt(unit @ unit)
                out.append((unit / norm + 0.0).tobytes() if norm > 0 else None)
                parts.append(f"{len(values)}:{name}" if norm > 0 else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(parts, pa.string()), pa.array(out, pa.binary())], ["id", "part", "v"]
            )

    return source.mapInArrow(run, f"id {kind}, part string, v binary")


def net(points: np.ndarray, radius: float, centres: np.ndarray, step: int = 256) -> np.ndarray:
    """``centres`` and as many more of ``points``, in order, as it takes for every point to
    lie within ``radius`` of one. Indices."""
    chosen = list(centres)
    for lo in range(0, len(points), step):
        part = points[lo : lo + step]
        far = np.ones(len(part), bool)
        if chosen:
            far = _distances(part, points[chosen]).min(axis=1) > radius
        todo = np.flatnonzero(far)
        if len(todo):
            near = _distances(part[todo], part[todo]) <= radius
            open_ = np.ones(len(todo), bool)
            for i in range(len(todo)):
                if open_[i]:
                    chosen.append(lo + int(todo[i]))
                    open_ &= ~near[i]
    return np.array(chosen, np.int64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Chord distances of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class CoverTree:
    """Nested nets with halving radii. Level k has centres, each one's parent on the level
    above, and the covering radius: the largest distance to a point below it."""

    def __init__(self, points: np.ndarray, least: float) -> None:
        self.points = points
        self.centres = [np.zeros(1, np.int64)]
        radius = float(_distances(points, points[:1]).max())
        while radius > least and len(self.centres[-1]) < len(points):
            radius /= 2
            self.centres.append(net(points, radius, self.centres[-1]))
        leaf = self._nearest(points, points[self.centres[-1]])
        order = np.argsort(leaf, kind="stable")
        bounds = np.searchsorted(leaf[order], np.arange(len(self.centres[-1]) + 1))
        self.members = [order[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        self.parents = [
            self._nearest(points[low], points[high])
            for high, low in zip(self.centres[:-1], self.centres[1:], strict=True)
        ]
        self.radii: list[np.ndarray] = []
        above = leaf
        for level in reversed(range(len(self.centres))):
            centre = points[self.centres[level][above]]
            far = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", points, centre), 0))
            radii = np.zeros(len(self.centres[level]))
            np.maximum.at(radii, above, far)
            self.radii.insert(0, radii)
            if level:
                above = self.parents[level - 1][above]

    @staticmethod
    def _nearest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.concatenate([(a[i : i + 1024] @ b.T).argmax(axis=1) for i in range(0, len(a), 1024)])

    def level(self, k: int) -> int:
        return min(k, len(self.centres) - 1)


def leaf_pairs(a: CoverTree, b: CoverTree, most: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members of the pairs of leaves that may hold points within ``most`` of each other."""
    alive = np.ones((1, 1), bool)
    for k in range(max(len(a.centres), len(b.centres))):
        i, j = a.level(k), b.level(k)
        if k and i == k:
            alive = alive[a.parents[i - 1]]
        if k and j == k:
            alive = alive[:, b.parents[j - 1]]
        near = _distances(a.points[a.centres[i]], b.points[b.centres[j]])
        near -= a.radii[i][:, None]
        near -= b.radii[j][None, :]
        alive = alive & (near <= most + SLACK)
    for x, y in zip(*np.nonzero(alive), strict=True):
        if a is not b or x <= y:
            yield a.members[x], b.members[y]


def _group_links(a: CoverTree, b: CoverTree, mult_a: np.ndarray, mult_b: np.ndarray, threshold: float):
    """Links of each point of a and b with the other's, and a member of each one's group
    (numbers: a's points, then b's; one tree with itself counts once)."""
    one = a is b
    n_a, n = len(mult_a), len(mult_a) + (0 if one else len(mult_b))
    links, group = np.zeros(n, np.int64), np.arange(n)

    def top(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return int(i)

    most = float(np.sqrt(2 - 2 * threshold))
    for x, y in leaf_pairs(a, b, most):
        same = one and x is y
        hit = a.points[x] @ b.points[y].T >= threshold
        if same:
            np.fill_diagonal(hit, False)
        if not hit.any():
            continue
        links[x] += hit @ mult_b[y]
        if not same:
            links[y + (0 if one else n_a)] += hit.T @ mult_a[x]
        for row, i in zip(hit, x, strict=True):
            if row.any():
                ends = np.unique(group[y[row] + (0 if one else n_a)])
                roots = {top(int(e)) for e in ends} | {top(int(i))}
                least = min(roots)
                for r in roots:
                    group[r] = least
    return links, np.array([top(i) for i in range(n)], np.int64) if n else group


def _top_centres(nodes: DataFrame, sizes: DataFrame, block: int) -> dict[str, np.ndarray]:
    """Centres by part, from the bounded sample; parts that fit one block have none."""
    large = sizes.where(F.col("n") > block).orderBy(F.desc("n"), "part").limit(TOP_LABELS).collect()
    if not large:
        return {}
    each = TOP_SAMPLE // len(large)
    # A hash decides, at a rate of ``each`` vectors per part; what chance adds is cut off.
    rates = nodes.sparkSession.createDataFrame(
        [(r["part"], min(1.0, each / r["n"])) for r in large], "part string, rate double"
    )
    rank = F.pmod(F.xxhash64("node"), F.lit(1_000_003)) / 1_000_003
    sample = nodes.join(F.broadcast(rates), "part").where(rank < F.col("rate"))
    drawn: dict[str, list[np.ndarray]] = {}
    for r in sample.orderBy(F.xxhash64("node"), "node").limit(TOP_SAMPLE).select("part", "v").collect():
        drawn.setdefault(r["part"], []).append(np.frombuffer(r["v"]))
    out = {}
    for r in large:
        points = np.array(drawn.get(r["part"], []))
        # A part of more blocks than sample vectors has a centre at each of these; its cells
        # then hold several blocks.
        wanted = min(-(-r["n"] // block), len(points))
        if not wanted:
            continue
        radius, centres = 2.0, np.zeros(1, np.int64)
        while len(centres) < wanted and radius > 1e-3:
            radius /= 2
            centres = net(points, radius, centres)
        out[r["part"]] = points[centres[: 2 * wanted]]
    return out


def near_vectors(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    units = unit_vectors(rows, id_column, vector, label)
    node = F.unhex(F.md5(F.concat_ws(":", F.hex("v"), "part")))
    units = written(units.withColumn("node", F.when(F.col("v").isNotNull(), node)), "vectors")
    real = units.where("node is not null")
    nodes = real.groupBy("node", "part", "v").agg(F.count("*").alias("mult"))
    first = real.groupBy("node").agg(F.min("id").alias("first"), F.count("*").alias("mult"))
    sizes = nodes.groupBy("part").agg(F.count("*").alias("n"))
    tops = _top_centres(nodes, sizes, block)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = np.zeros(len(batch), np.int32), np.full(len(batch), 2.0)
            parts = batch.column(1).dictionary_encode()
            of = parts.indices.to_numpy(zero_copy_only=False)
            for k, part in enumerate(parts.dictionary.to_pylist()):
                if part not in tops:
                    continue
                mine = np.flatnonzero(of == k)
                # As many rows at once as keep the matrix of distances at 8 MB.
                step = max(1, (1 << 20) // len(tops[part]))
                for lo in range(0, len(mine), step):
                    rows = mine[lo : lo + step]
                    points = np.array([np.frombuffer(v) for v in batch.column(2).take(pa.array(rows)).to_pylist()])
                    distance = _distances(points, tops[part])
                    cell[rows] = distance.argmin(axis=1)
                    far[rows] = distance[np.arange(len(rows)), cell[rows]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(far)], ["node", "part", "v", "mult", "cell", "far"]
            )

    celled = written(
        nodes.select("node", "part", "v", "mult").mapInArrow(
            place, "node binary, part string, v binary, mult long, cell int, far double"
        ),
        "nodes",
    )
    cells = celled.groupBy("part", "cell").agg(
        F.ceil(F.count("*") / block).cast("int").alias("chunks"), F.max("far").alias("radius")
    )
    blocks = cells.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    left = blocks.select("part", *[F.col(c).alias(f"{c}_a") for c in ("cell", "chunk", "radius")])
    right = blocks.select("part", *[F.col(c).alias(f"{c}_b") for c in ("cell", "chunk", "radius")])
    most = float(np.sqrt(2 - 2 * threshold))

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for part, a, b, ra, rb in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
                centres = tops.get(part)
                apart = 0.0 if centres is None else float(_distances(centres[a][None], centres[b][None])[0, 0])
                keep.append(apart - ra - rb <= most + SLACK)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep, pa.bool_())) for c in batch.columns], batch.schema.names
            )

    order = F.struct("cell_a", "chunk_a") <= F.struct("cell_b", "chunk_b")
    pairs = (
        left.join(right, "part")
        .where(order)
        .select("part", "cell_a", "cell_b", "radius_a", "radius_b", "chunk_a", "chunk_b")
        .mapInArrow(
            prune,
            "part string, cell_a int, cell_b int, radius_a double, radius_b double, chunk_a int, chunk_b int",
        )
        .drop("radius_a", "radius_b")
    )
    pairs = written(pairs, "node-pairs")
    # Each vector goes to the tasks of all surviving pairs of its block.
    keyed = celled.join(cells.select("part", "cell", "chunks"), ["part", "cell"]).withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    )
    ends = pairs.select(
        "*",
        F.explode(
            F.array_distinct(
                F.array(
                    F.struct(F.col("cell_a").alias("cell"), F.col("chunk_a").alias("chunk")),
                    F.struct(F.col("cell_b").alias("cell"), F.col("chunk_b").alias("chunk")),
                )
            )
        ).alias("end"),
    ).select("part", "cell_a", "chunk_a", "cell_b", "chunk_b", "end.cell", "end.chunk")
    met = keyed.join(ends, ["part", "cell", "chunk"])

    def compare(table: pa.Table) -> pa.Table:
        node, mult = table["node"].combine_chunks(), table["mult"].to_numpy()
        points = np.array([np.frombuffer(v) for v in table["v"].to_pylist()])
        cell, chunk = table["cell"].to_numpy(), table["chunk"].to_numpy()
        in_a = (cell == table["cell_a"][0].as_py()) & (chunk == table["chunk_a"][0].as_py())
        in_b = (cell == table["cell_b"][0].as_py()) & (chunk == table["chunk_b"][0].as_py())
        least = LEAF_SHARE * most
        if (in_a == in_b).all():
            tree = CoverTree(points, least)
            links, group = _group_links(tree, tree, mult, mult, threshold)
            order = np.arange(len(points))
        elif in_a.any() and in_b.any():
            a, b = np.flatnonzero(in_a), np.flatnonzero(in_b)
            order = np.concatenate([a, b])
            trees = CoverTree(points[a], least), CoverTree(points[b], least)
            links, group = _group_links(*trees, mult[a], mult[b], threshold)
        else:
            links, group, order = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        full = np.flatnonzero(links)
        return pa.table(
            {
                "node": node.take(pa.array(order[full])),
                "peer": node.take(pa.array(order[group[full]])),
                "n": pa.array(links[full], pa.int64()),
            }
        )

    found = written(
        met.groupBy("part", "cell_a", "chunk_a", "cell_b", "chunk_b").applyInArrow(
            compare, "node binary, peer binary, n long"
        ),
        "links",
    )
    roots = components(found.select(F.col("node").alias("a"), F.col("peer").alias("b")))
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    known = (
        first.join(links, "node", "left")
        .join(roots, "node", "left")
        .select(
            "node",
            (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
            "first",
        )
    )
    # Both written: a join on top of the aggregate could not be split where a component is large.
    known = written(known, "known")
    smallest = written(known.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    named = known.join(smallest, "root").select("node", "n_links", "component_id")
    out = units.select("id", "node").join(named, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
