"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors are projected on their leading principal dimensions and sorted by the grid cells
there, with cells as wide as the largest distance of a link. The sequence is cut into blocks
with bounding boxes. Pairs of sequence intervals are joined level by level, from a few long ones
down to blocks, and a pair is dropped as soon as its boxes are provably too far apart; what is
left is joined in tasks, where the halving goes on to small dense products. A pair of blocks
gives counts and a star per component, never its pairs of vectors.

Cosines are computed in double precision from the stored components, floats or doubles. Equal
vectors of a label are joined once and weighed by their number. Vectors of each length are
joined among themselves; labels may be of any type that has a text.

Defined results: vectors that are null, zero, or hold null or non-finite components, and vectors
without a label, link with nothing and are kept; vectors of different lengths do not link; rows
that share an id are one node; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.llm.components import connected_components
from paceline.sources.scratch import written

COSINE, LEADING, BLOCK, FAN_OUT, DENSE = 0.98, 6, 1024, 16, 128
SLACK = 1e-6  # of distances in the projection, which are rounded


def usable(vector: str) -> Column:
    """Neither null nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    scale = np.abs(x).max(axis=1, keepdims=True)  # squares of tiny or huge components stay finite
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, dim: int, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading eigenvectors of the covariance of all unit vectors.

    Tasks send sums, one per pair of dimensions; the driver gets dim x (dim + 3) / 2 + 1 numbers.
    """
    upper = np.triu_indices(dim)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + dim + len(upper[0]))
        for batch in batches:
            x = _unit(_matrix(batch.column(0)))
            total += np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x)[upper]]) if len(x) else 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])

    rows = vectors.select("embedding").mapInArrow(sums, "i long, v double").groupBy("i").agg(F.sum("v")).collect()
    total = np.zeros(1 + dim + len(upper[0]))
    for i, v in rows:
        total[i] = v
    n = max(total[0], 1)
    mean = total[1:1 + dim] / n
    second = np.zeros((dim, dim))
    second[upper] = total[1 + dim:] / n
    covariance = second + np.triu(second, 1).T - np.outer(mean, mean)
    _, axes = np.linalg.eigh(covariance)
    return mean, axes[:, ::-1][:, :leading]


def _blocks(vectors: DataFrame, mean: np.ndarray, axes: np.ndarray, epsilon: float, block: int) -> DataFrame:
    """The vectors in epsilon grid order, cut into blocks of one label with bounding boxes."""
    lead = axes.shape[1]
    cells = [f"c{k}" for k in range(lead)]
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = (_unit(_matrix(batch.column(3))) - mean) @ axes
            grid = np.floor(p / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(grid[:, k]) for k in range(lead)]],
                                             names=[*batch.schema.names, *cells])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, places = None, {}
        for batch in batches:
            table = pa.Table.from_batches([batch.select([0, 1, 2, 3])])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            while waiting.num_rows >= 4 * block:
                used, rows = _cut_blocks(waiting, places, mean, axes, block, last=False)
                yield rows
                waiting = waiting.slice(used)
        if waiting is not None and waiting.num_rows:
            yield _cut_blocks(waiting, places, mean, axes, block, last=True)[1]

    grid = vectors.select("node", "label", "n", "embedding").mapInArrow(
        project, f"node long, label string, n long, embedding array<{kind}>, " + ", ".join(f"{c} int" for c in cells))
    order = ["label", *cells, "node"]
    return grid.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        cut, f"task int, place int, label string, nodes array<long>, weights array<long>, vectors array<{kind}>, "
             "low array<double>, high array<double>")


def _cut_blocks(table: pa.Table, places: dict, mean, axes, block: int, last: bool) -> tuple[int, pa.RecordBatch]:
    """``places`` keeps only the label in hand: rows come sorted by label."""
    label = table.column("label").to_numpy()
    ends = np.concatenate([np.flatnonzero(label[1:] != label[:-1]) + 1, [len(label)]])
    rows, at = [], 0
    task = TaskContext.get().partitionId()
    for end in ends:
        while at < end:
            stop = min(at + block, end)
            if not last and stop == len(label):
                break
            piece = table.slice(at, stop - at).combine_chunks()
            x = _matrix(piece.column("embedding").combine_chunks())
            p = (_unit(x) - mean) @ axes
            place = places.get(label[at], -1) + 1
            places.clear()
            places[label[at]] = place
            rows.append((task, place, label[at], piece.column("node").to_pylist(), piece.column("n").to_pylist(),
                         x.ravel(), p.min(axis=0), p.max(axis=0)))
            at = stop
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()),
             pa.list_(table.schema.field("embedding").type.value_type), pa.list_(pa.float64()), pa.list_(pa.float64())]
    names = ["task", "place", "label", "nodes", "weights", "vectors", "low", "high"]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return at, pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def _near(a: str, b: str, lead: int, epsilon: float) -> Column:
    """Whether two boxes come within epsilon of each other in the projection."""
    total = F.lit(0.0)
    for k in range(lead):
        gap = F.greatest(F.col(f"{a}.low")[k] - F.col(f"{b}.high")[k], F.col(f"{b}.low")[k] - F.col(f"{a}.high")[k], F.lit(0.0))
        total = total + gap * gap
    return total <= (epsilon + SLACK) ** 2


def _block_pairs(boxes: DataFrame, lead: int, epsilon: float) -> DataFrame:
    """Pairs of block numbers (within a label) whose boxes are near, by levels of intervals."""
    most = boxes.agg(F.max("at")).first()[0] or 0
    levels = 0
    while most >> (4 * levels) >= FAN_OUT:
        levels += 1

    def intervals(level: int) -> DataFrame:
        box = [F.array(*[f(F.col(side)[k]) for k in range(lead)]).alias(side)
               for side, f in (("low", F.min), ("high", F.max))]
        return boxes.groupBy("label", F.shiftright("at", 4 * level).alias("at")).agg(*box)

    def near_pairs(left: DataFrame, right: DataFrame, on) -> DataFrame:
        pairs = left.alias("a").join(right.alias("b"), on & (F.col("a.at") <= F.col("b.at")) & _near("a", "b", lead, epsilon))
        return pairs.select("a.label", F.col("a.at").alias("left"), F.col("b.at").alias("right"))

    top = intervals(levels)
    pairs = near_pairs(top, top, F.col("a.label") == F.col("b.label"))  # at most 16 intervals of a label
    for level in range(levels - 1, -1, -1):
        parts = intervals(level).withColumn("within", F.shiftright("at", 4))
        lefts = pairs.join(parts.withColumnRenamed("label", "of"),
                           (F.col("label") == F.col("of")) & (F.col("left") == F.col("within")))
        lefts = lefts.select("label", "right", "at", "low", "high")
        pairs = near_pairs(lefts, parts, (F.col("a.label") == F.col("b.label")) & (F.col("a.right") == F.col("b.within")))
    return pairs


class _Side:
    """One block in a task: unit vectors, their projection, nodes and weights."""

    def __init__(self, nodes, weights, vectors, mean, axes):
        self.nodes = np.asarray(nodes, dtype=np.int64)
        self.weights = np.asarray(weights, dtype=np.int64)
        self.unit = _unit(np.asarray(vectors).reshape(len(self.nodes), -1))
        self.projected = (self.unit - mean) @ axes


def join_intervals(a: _Side, b: _Side, same: bool, epsilon: float, cosine: float):
    """Link counts of both sides and linked (left, right) positions, by recursive halving."""
    counts = np.zeros(len(a.nodes), dtype=np.int64), np.zeros(len(b.nodes), dtype=np.int64)
    lefts, rights = [], []
    tasks = [(0, len(a.nodes), 0, len(b.nodes))]
    while tasks:
        i, j, k, m = tasks.pop()
        pa_, pb = a.projected[i:j], b.projected[k:m]
        gap = np.maximum(np.maximum(pa_.min(axis=0) - pb.max(axis=0), pb.min(axis=0) - pa_.max(axis=0)), 0)
        if gap @ gap > (epsilon + SLACK) ** 2 or (same and m <= i):
            continue
        if j - i > DENSE or m - k > DENSE:
            rows = [(i, (i + j) // 2), ((i + j) // 2, j)] if j - i > DENSE else [(i, j)]
            columns = [(k, (k + m) // 2), ((k + m) // 2, m)] if m - k > DENSE else [(k, m)]
            tasks += [(*r, *c) for r in rows for c in columns]
            continue
        linked = a.unit[i:j] @ b.unit[k:m].T >= cosine
        if same:
            linked &= np.arange(i, j)[:, None] < np.arange(k, m)[None, :]
        counts[0][i:j] += linked @ b.weights[k:m]
        counts[1][k:m] += a.weights[i:j] @ linked
        x, y = np.nonzero(linked)
        # A spanning part is enough: each left with its first right, each right with its first left.
        if len(x):
            first_y = np.concatenate([[True], x[1:] != x[:-1]])
            order = np.lexsort((x, y))
            first_x = np.concatenate([[True], y[order][1:] != y[order][:-1]])
            lefts += [i + x[first_y], i + x[order][first_x]]
            rights += [k + y[first_y], k + y[order][first_x]]
            if not _spans(x, y, first_y, order[first_x], j - i, m - k):
                lefts.append(i + x)
                rights.append(k + y)
    empty = np.zeros(0, dtype=np.int64)
    return counts, np.concatenate([empty, *lefts]), np.concatenate([empty, *rights])


def _spans(x, y, first_y, first_x, n, m) -> bool:
    """Whether the chosen links connect all that all links connect."""
    chosen = np.concatenate([np.flatnonzero(first_y), first_x])
    label = _components(n + m, x[chosen], n + y[chosen])
    return bool((label[x] == label[n + y]).all())


def _components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        for at in (left, right, label[left], label[right]):
            np.minimum.at(new, at, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _join_blocks(pairs: DataFrame, mean, axes, epsilon: float, cosine: float) -> DataFrame:
    """Rows (node, links, least): a node's links in a pair of blocks and the least node there."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                same, *columns = [batch.column(c)[row] for c in range(batch.num_columns)]
                values = [c.values.to_numpy(zero_copy_only=False) for c in columns]
                a = _Side(*values[:3], mean, axes)
                b = a if same.as_py() else _Side(*values[3:], mean, axes)
                (n_a, n_b), x, y = join_intervals(a, b, same.as_py(), epsilon, cosine)
                if same.as_py():
                    nodes, links, label = a.nodes, n_a + n_b, _components(len(a.nodes), x, y)
                else:
                    nodes, links = np.concatenate([a.nodes, b.nodes]), np.concatenate([n_a, n_b])
                    label = _components(len(nodes), x, len(a.nodes) + y)
                # The least node of a component, which need not stand first in the sequence.
                least = nodes.copy()
                np.minimum.at(least, label, nodes)
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[at]), pa.array(links[at]), pa.array(least[label][at])], names=["node", "links", "least"])

    return pairs.mapInArrow(joined, "node long, links long, least long")


def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with ``at``, their number within the label: places in a task after those of earlier tasks.

    The running sum has a row for each label and task, not one for each block.
    """
    here = blocks.groupBy("label", "task").agg((F.max("place") + 1).alias("blocks"))
    before = Window.partitionBy("label").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = here.select("label", "task", F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("offset"))
    return blocks.join(offsets, ["label", "task"]).withColumn("at", F.col("offset") + F.col("place")).drop("offset")


def _links(vectors: DataFrame, dim: int, epsilon: float, cosine: float, leading: int, block: int) -> DataFrame:
    """Rows (node, links, least) of all pairs of near blocks among vectors of one length."""
    mean, axes = principal_axes(vectors, dim, min(leading, dim))
    lead = axes.shape[1]
    blocks = written(_blocks(vectors, mean, axes, epsilon, block), "blocks")
    boxes = written(_numbered(blocks.select("label", "task", "place", "low", "high")), "boxes")
    pairs = _block_pairs(boxes.select("label", "at", "low", "high"), lead, epsilon)
    data = blocks.join(boxes.select("label", "task", "place", "at"), ["label", "task", "place"])
    named = [data.select(F.col("label").alias(f"l{s}"), F.col("at").alias(f"at{s}"), *[F.col(c).alias(c + s) for c in ("nodes", "weights", "vectors")])
             for s in ("_a", "_b")]
    work = (pairs.join(named[0], (F.col("label") == F.col("l_a")) & (F.col("left") == F.col("at_a")))
            .join(named[1], (F.col("label") == F.col("l_b")) & (F.col("right") == F.col("at_b")))
            .select((F.col("left") == F.col("right")).alias("same"), "nodes_a", "weights_a", "vectors_a",
                    "nodes_b", "weights_b", "vectors_b"))
    return written(_join_blocks(work, mean, axes, epsilon, cosine), "embedding-links")


def near_duplicates(table: DataFrame, cosine: float = COSINE, leading: int = LEADING, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of (vec_id, embedding, label)."""
    epsilon = float(np.sqrt(2 - 2 * cosine))
    stored = table.schema["embedding"].dataType.elementType.simpleString()
    kind = "float" if stored == "float" else "double"
    rows = table.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    ok = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("key", F.when(ok, F.xxhash64("label", "embedding"))).withColumn("check", F.when(ok, F.hash("embedding", "label")))

    distinct = written(rows.where("key IS NOT NULL").groupBy("key", "check", "label", "embedding")
                       .agg(F.min("vec_id").alias("node"), F.count("*").alias("n")), "vectors")
    dims = [r["dim"] for r in distinct.select(F.size("embedding").alias("dim")).distinct().orderBy("dim").collect()]
    if not dims:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    parts = [_links(distinct.where(F.size("embedding") == dim), dim, epsilon, cosine, leading, block) for dim in dims]
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(found, "node", "least").withColumnRenamed("node", "linked")
    nodes = (distinct.select("key", "check", "node", "n").join(links, "node", "left")
             .join(components, F.col("node") == F.col("linked"), "left")
             .select(F.col("key").alias("k"), F.col("check").alias("c"),
                     (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    return (rows.select("vec_id", "key", "check")
            .join(nodes, (F.col("key") == F.col("k")) & (F.col("check") == F.col("c")), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
