"""Hard-negative mining with rotated one-bit codes and residual intervals.

Vectors become integers, x = floor(scale * component). Each is rotated by a fixed random
orthogonal matrix and coded in stages: the signs of what is left make a one-bit code, its
alignment (the projection on the code vector) is stored, and the projection is taken away for
the next stage; the length of the last residual is stored too. A query rotates alike and is cut
into bit planes, so its product with a code vector is a few popcounts. The sum over the stages
estimates the inner product, and by Cauchy-Schwarz the rest is at most the residual's length
times the part of the query across the last code vector, plus the rounding of the planes. Only
vectors whose interval reaches the wanted scores are scored on the integers, exactly; so no row
is lost and every score is exact.

Anchors go out to the tasks in groups of a stated size, and each group passes over all coded
rows in blocks: first for the best rows of the anchor's label (the positives), then for the best
other rows within the band of each positive's score. A task keeps a bounded list per anchor, so
equal labels and equal vectors, however many, meet in no one task. The work is anchors x rows
popcounts, as an exact search of all rows needs.

Defined results: rows with a null id, label or vector, a null or non-finite component, an empty
vector, or an integer vector whose squared length reaches 2**62 (scores would not fit a long) take no part;
of rows that share an id the one with the least label, then vector, takes part. Vectors of
different lengths have no score. Ties go to the smaller id; zero vectors score 0; an anchor
without another row of its label gives nothing; an empty table gives an empty result. Other
columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.llm.whitening import lattice_rows
from paceline.sources.scratch import new_dir, written

SQUARED_LIMIT = float(1 << 62)
ROUNDING = 1e-9  # of the products of lengths: far above the error of the float sums
CODED = "id long, label string, dim int, x binary, codes binary, aligned binary, rest double, length double"
NEAR = "anchor_id long, positive_id long, positive_score long"
FAR = "anchor_id long, positive_score long, negative_id long, negative_score long"


@dataclass(frozen=True)
class MiningParams:
    """Band limits are percent of the positive's score, both included.

    ``anchors_per_pass`` is about how many anchors travel to every task at a time.
    """

    scale: float = 256.0
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    stages: int = 3
    planes: int = 6
    anchors_per_pass: int = 4096
    seed: int = 29


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    packed = np.packbits(flags, axis=1, bitorder="little")
    out = np.zeros((len(flags), -(-flags.shape[1] // 64) * 8), dtype=np.uint8)
    out[:, :packed.shape[1]] = packed
    return out.view(np.uint64)


def encode(x: np.ndarray, params: MiningParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows x stages x words), alignments, length of the last residual, length."""
    left = x.astype(np.float64) @ rotation(x.shape[1], params.seed).T
    codes, aligned = [], []
    for _ in range(params.stages):
        up = left >= 0
        along = np.abs(left).mean(axis=1) if x.shape[1] else np.zeros(len(x))
        left = left - np.where(up, along[:, None], -along[:, None])
        codes.append(_bits(up))
        aligned.append(along)
    lengths = np.linalg.norm(x.astype(np.float64), axis=1)
    return np.stack(codes, axis=1), np.stack(aligned, axis=1), np.linalg.norm(left, axis=1), lengths


class Query:
    """An anchor's rotated vector in bit planes."""

    def __init__(self, x: np.ndarray, params: MiningParams):
        self.x = x
        q = x.astype(np.float64) @ rotation(len(x), params.seed).T
        top = (1 << params.planes) - 1
        self.low = q.min(initial=0)
        self.step = (q.max(initial=0) - self.low) / top or 1.0
        cut = np.clip(np.rint((q - self.low) / self.step), 0, top).astype(np.int64)
        self.total = int(cut.sum())
        self.planes = _bits(np.stack([(cut >> j) & 1 == 1 for j in range(params.planes)]))
        rounded = self.low + self.step * cut
        self.squared = float(rounded @ rounded)
        self.rounding = float(np.linalg.norm(q - rounded))
        self.length = float(np.linalg.norm(q))


class Block:
    """Coded rows of one length in a task; ``labels`` are places in ``names``."""

    def __init__(self, dim: int, names: dict[str, int], ids, labels, x, codes, aligned, rest, length):
        self.dim, self.names, self.ids, self.labels, self.x = dim, names, ids, labels, x
        self.codes, self.aligned, self.rest, self.length = codes, aligned, rest, length
        self.ones = np.bitwise_count(codes).sum(axis=2, dtype=np.int64)

    def part(self, at) -> Block:
        out = Block.__new__(Block)
        out.dim, out.names = self.dim, self.names
        for name in ("ids", "labels", "x", "codes", "aligned", "rest", "length", "ones"):
            setattr(out, name, getattr(self, name)[at])
        return out

    def intervals(self, q: Query) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of every row's inner product with the query."""
        estimate = np.zeros(len(self.ids))
        along = np.zeros(len(self.ids))
        for stage in range(self.codes.shape[1]):
            both = np.zeros(len(self.ids), dtype=np.int64)
            for j in range(len(q.planes)):
                for word in range(self.codes.shape[2]):
                    both += np.bitwise_count(self.codes[:, stage, word] & q.planes[j, word]).astype(np.int64) << j
            along = q.low * (2 * self.ones[:, stage] - self.dim) + q.step * (2 * both - q.total)
            estimate += self.aligned[:, stage] * along
        across = np.sqrt(np.maximum(q.squared - along * along / max(self.dim, 1), 0))
        width = self.rest * across + self.length * (q.rounding + ROUNDING * (q.length + 1))
        return estimate - width, estimate + width

    def scores(self, at: np.ndarray, q: Query) -> np.ndarray:
        return self.x[at] @ q.x


def best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Positions of the ``count`` highest scores, ties by smaller id."""
    return np.lexsort((ids, -scores))[:count]


def _blocks(batch: pa.RecordBatch, stages: int) -> Iterator[Block]:
    names = batch.schema.names
    column = lambda c: batch.column(names.index(c))
    dims = column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        at = pa.array(np.flatnonzero(dims == dim))
        part = lambda c: column(c).take(at)  # noqa: E731, B023
        raw = lambda c, kind: np.frombuffer(b"".join(part(c).to_pylist()), dtype=kind)  # noqa: E731, B023
        n = len(at)
        label = part("label").dictionary_encode()
        places = {name: k for k, name in enumerate(label.dictionary.to_pylist())}
        yield Block(dim, places, part("id").to_numpy(), label.indices.to_numpy(),
                    raw("x", "<i4").reshape(n, dim).astype(np.int64), raw("codes", "<u8").reshape(n, stages, -(-dim // 64)),
                    raw("aligned", "<f8").reshape(n, stages), part("rest").to_numpy(), part("length").to_numpy())


def coded(table: DataFrame, params: MiningParams, id: str, label: str, vector: str) -> DataFrame:
    """One coded row for each id that takes part."""
    whole = table.select(F.col(id).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
                         F.col(vector).cast("array<double>").alias("x")).where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in lattice_rows(batch.column(2), params.scale):
                small = ((x.astype(np.float64) ** 2).sum(axis=1) < SQUARED_LIMIT) & (x.shape[1] > 0)
                at = pa.array(at[small])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.full(len(at), x.shape[1], dtype=np.int32)),
                     pa.array([v.tobytes() for v in x[small].astype("<i4")], pa.binary())], names=["id", "label", "dim", "x"])

    first = F.min(F.struct("label", "dim", "x")).alias("row")
    rows = whole.mapInArrow(usable, "id long, label string, dim int, x binary").groupBy("id").agg(first).select("id", "row.*")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                at = pa.array(np.flatnonzero(dims == dim))
                part = batch.take(at)
                x = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype="<i4").reshape(len(at), dim).astype(np.int64)
                codes, aligned, rest, length = encode(x, params)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array([a.tobytes() for a in aligned], pa.binary()), pa.array(rest), pa.array(length)],
                    names=[c.split()[0] for c in CODED.split(", ")])

    return rows.mapInArrow(encoded, CODED)


def _queries(anchors: list[tuple[int, str, int, bytes]], params: MiningParams) -> dict[int, list[tuple[int, str, Query]]]:
    """Anchors by vector length."""
    out: dict[int, list] = {}
    for id_, label, dim, x in anchors:
        out.setdefault(dim, []).append((id_, label, Query(np.frombuffer(x, dtype="<i4").astype(np.int64), params)))
    return out


def _merge(kept: tuple[np.ndarray, np.ndarray] | None, scores: np.ndarray, ids: np.ndarray, count: int):
    if kept is not None:
        scores, ids = np.concatenate([kept[0], scores]), np.concatenate([kept[1], ids])
    top = best(scores, ids, count)
    return scores[top], ids[top]


def _floor(kept, count: int, sure: np.ndarray) -> float:
    """No row below this can be among the best: the last of ``count`` known scores or lower bounds."""
    known = -np.inf if kept is None or len(kept[0]) < count else float(kept[0][-1])
    return max(known, np.partition(sure, len(sure) - count)[len(sure) - count]) if len(sure) >= count else known


def _nearest(rows: DataFrame, anchors, params: MiningParams) -> DataFrame:
    """Each task's best rows of the anchors' labels."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)  # about anchors_per_pass vectors

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, kept = _queries(shared.value, params), {}
        wanted = {dim: {label for _, label, _ in qs} for dim, qs in queries.items()}
        for batch in batches:
            for block in _blocks(batch, params.stages):
                order = np.argsort(block.labels, kind="stable")
                edges = np.searchsorted(block.labels[order], np.arange(len(block.names) + 1))
                own = {label: block.part(order[edges[k]:edges[k + 1]]) for label, k in block.names.items()
                       if label in wanted.get(block.dim, ())}
                for id_, label, q in queries.get(block.dim, ()):
                    part = own.get(label)
                    if part is None:
                        continue
                    low, high = part.intervals(q)
                    other = part.ids != id_
                    at = np.flatnonzero(other & (high >= _floor(kept.get(id_), params.positives, low[other])))
                    if len(at):
                        kept[id_] = _merge(kept.get(id_), part.scores(at, q), part.ids[at], params.positives)
        columns = [(a, p, s) for a, (scores, ids) in kept.items() for s, p in zip(scores.tolist(), ids.tolist())]
        yield _batch(columns, NEAR)

    return rows.mapInArrow(found, NEAR)


def _banded(rows: DataFrame, anchors, bands: dict[int, list[int]], params: MiningParams) -> DataFrame:
    """Each task's best rows of other labels within the band of each positive score of an anchor."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, bands))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, bands = shared.value
        queries, kept = _queries(anchors, params), {}
        for batch in batches:
            for block in _blocks(batch, params.stages):
                for id_, label, q in queries.get(block.dim, ()):
                    if id_ not in bands:
                        continue
                    low, high = block.intervals(q)
                    other = block.labels != block.names.get(label, -1)
                    spans = [(score, *band(score, params)) for score in bands[id_]]
                    reach = []
                    for score, least, most in spans:
                        sure = low[other & (low >= least) & (high <= most)]
                        floor = max(least, _floor(kept.get((id_, score)), params.negatives, sure))
                        reach.append(other & (high >= floor) & (low <= most))
                    at = np.flatnonzero(np.any(reach, axis=0)) if reach else []
                    if not len(at):
                        continue
                    scores, ids = block.scores(at, q), block.ids[at]
                    for score, least, most in spans:
                        inside = (scores >= least) & (scores <= most)
                        if inside.any():
                            kept[id_, score] = _merge(kept.get((id_, score)), scores[inside], ids[inside], params.negatives)
        columns = [(a, p, n, s) for (a, p), (scores, ids) in kept.items() for s, n in zip(scores.tolist(), ids.tolist())]
        yield _batch(columns, FAR)

    return rows.mapInArrow(found, FAR)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def band(score: int, params: MiningParams) -> tuple[int, int]:
    """Least and greatest score s with low * score <= 100 * s <= high * score."""
    return -(-params.low * score // 100), params.high * score // 100


def _first(rows: DataFrame, keys: list[str], score: str, id: str, count: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), id)
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= count)


def mine(table: DataFrame, anchor: Column, params: MiningParams = MiningParams(), *, id: str = "vec_id",
         label: str = "label", vector: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` picks the anchors by the column ``id`` (a long).
    """
    spark = table.sparkSession
    rows = written(coded(table, params, id, label, vector), "coded-vectors")
    chosen = rows.where(anchor).select("id", "label", "dim", "x")
    groups = max(1, -(-chosen.count() // params.anchors_per_pass))
    near_path, far_path = new_dir(spark, "positives"), new_dir(spark, "negatives")
    for group in range(groups):
        of_group = chosen.where(F.pmod(F.xxhash64("id"), F.lit(groups)) == group)
        anchors = [(r["id"], r["label"], r["dim"], bytes(r["x"])) for r in of_group.orderBy("id").collect()]
        near = _first(_nearest(rows, anchors, params), ["anchor_id"], "positive_score", "positive_id", params.positives, "near_rank")
        near.write.parquet(f"{near_path}/pass={group}")
        bands: dict[int, list[int]] = {}
        for r in spark.read.schema(NEAR).parquet(f"{near_path}/pass={group}").collect():  # anchors x positives rows
            least, most = band(r["positive_score"], params)
            if least <= most and r["positive_score"] not in bands.setdefault(r["anchor_id"], []):
                bands[r["anchor_id"]].append(r["positive_score"])
        far = _first(_banded(rows, anchors, {a: sorted(b) for a, b in bands.items() if b}, params),
                     ["anchor_id", "positive_score"], "negative_score", "negative_id", params.negatives, "rank")
        far.write.parquet(f"{far_path}/pass={group}")
    near = spark.read.schema(NEAR).parquet(near_path)
    far = spark.read.schema(FAR + ", rank int").parquet(far_path)
    return near.join(far, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
