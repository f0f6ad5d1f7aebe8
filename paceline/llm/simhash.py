"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a covering code of 64-bit space: two Golay codes [23,12], a
repetition code [17,1] and one free bit, all perfect, so every fingerprint has one nearest
anchor in each block. A fingerprint goes to every anchor that lies within the covering radius
of each block plus a total excess of ``max_bits``; two fingerprints at most ``max_bits`` apart
then meet at the nearest anchor of either. With 2 bits that is about 75 of 2**26 anchors. Only
distinct fingerprints are replicated, so copies of a text cost nothing here.

At an anchor, small groups are compared directly. Larger ones are linked through shared
neighbours (two values differ in at most 2 bits exactly if some value is within 1 bit of
both), which is linear in the group. Each anchor gives a star per component, never all pairs.

Defined results: null and empty texts have no words and fingerprint zero, linked like any
other; a text shorter than a shingle is one shingle; repeated rows are kept, and a component
is named by the smallest doc_id (null if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from paceline.llm import common
from paceline.llm.components import connected_components
from paceline.sources.scratch import written

SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
_LOWER = bytes(common.byte_table())
_VOTES = 1 << 16  # shingles whose bits are unpacked at a time


def fingerprint(text: bytes, width: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Bits set in more than half of the XXH64 of a text's word shingles."""
    words = text.translate(_LOWER).split()  # bytes.split: space and 0x09 to 0x0D
    if not words:
        return 0
    width = min(width, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    begin = [0, *ends[:len(words) - width].tolist()]
    stop = (ends[width - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[b:e], seed) for b, e in zip(begin, stop)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(h), _VOTES):
        part = h[k:k + _VOTES].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[Column | str], width: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``keep`` columns and the fingerprint as a signed long ``fp``."""
    kept = docs.select(*keep, F.col("text").alias("_text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.texts_of(batch.column(batch.num_columns - 1))
            fp = np.array([fingerprint(t, width, seed) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp, pa.int64())],
                                             names=[*batch.schema.names[:-1], "fp"])

    return kept.mapInArrow(hashed, kept.drop("_text").withColumn("fp", F.lit(0).cast("long")).schema)


# -- the covering code -------------------------------------------------------------------

_GOLAY = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
_RADIUS, _REPEAT = 3, 17


def _syndrome(x: int) -> int:
    for bit in range(22, 10, -1):
        if x >> bit & 1:
            x ^= _GOLAY << (bit - 11)
    return x


class AnchorCode:
    """Anchors of 64-bit values, by excess over the covering radius of each block."""

    def __init__(self, max_bits: int = MAX_BITS):
        if not 0 <= max_bits <= 4:
            raise ValueError("max_bits must lie between 0 and 4")
        self.max_bits = max_bits
        units = [_syndrome(1 << b) for b in range(23)]
        low, high = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 11, dtype=np.int64)
        for table, shift in ((low, 0), (high, 12)):
            for b in range(int(np.log2(len(table)))):
                table[np.arange(len(table)) >> b & 1 == 1] ^= units[b + shift]
        self.low, self.high = low, high
        # Error patterns by syndrome: those of weight 0 to 3 are one for each syndrome.
        self.errors = []
        for excess in range(max_bits + 1):
            by_syndrome: list[list[int]] = [[] for _ in range(1 << 11)]
            weights = range(_RADIUS + 1) if excess == 0 else [_RADIUS + excess]
            for weight in weights:
                for bits in combinations(range(23), weight):
                    s = 0
                    for b in bits:
                        s ^= units[b]
                    by_syndrome[s].append(sum(1 << b for b in bits))
            most = max(map(len, by_syndrome))
            padded = np.full((1 << 11, most), -1, dtype=np.int64)
            for s, found in enumerate(by_syndrome):
                padded[s, :len(found)] = found
            self.errors.append(padded)

    def _golay(self, block: np.ndarray, excess: int) -> np.ndarray:
        """Codewords at this excess, -1 where there are fewer."""
        error = self.errors[excess][self.low[block & 0xFFF] ^ self.high[block >> 12]]
        return np.where(error >= 0, block[:, None] ^ error, -1)

    def _repeated(self, block: np.ndarray, excess: int) -> np.ndarray:
        ones = np.bitwise_count(block).astype(np.int64)
        near = (ones > _REPEAT // 2).astype(np.int64)
        if excess == 0:
            return near[:, None]
        away = np.where(near == 1, ones, _REPEAT - ones)  # distance to the other word
        return np.where(away - _REPEAT // 2 == excess, 1 - near, -1)[:, None]

    def replicas(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into fp, anchor) for every anchor each value goes to."""
        x = fp.view(np.uint64)
        a = (x & np.uint64(0x7FFFFF)).astype(np.int64)
        b = (x >> np.uint64(23) & np.uint64(0x7FFFFF)).astype(np.int64)
        c = (x >> np.uint64(46) & np.uint64(0x1FFFF)).astype(np.int64)
        d = (x >> np.uint64(63)).astype(np.int64)
        rows, anchors = [], []
        for ea, eb, ec, ed in product(*[range(self.max_bits + 1)] * 3, range(2)):
            if ea + eb + ec + ed > self.max_bits:
                continue
            left, right = self._golay(a, ea), self._golay(b, eb)
            rest = self._repeated(c, ec)[:, 0]
            key = left[:, :, None] | right[:, None, :] << 23
            ok = (left[:, :, None] >= 0) & (right[:, None, :] >= 0) & (rest >= 0)[:, None, None]
            key = key | (rest << 46)[:, None, None] | ((d ^ ed) << 47)[:, None, None]
            at = np.nonzero(ok)
            rows.append(at[0])
            anchors.append(key[at])
        return np.concatenate(rows), np.concatenate(anchors)


# -- comparison at the anchors -------------------------------------------------------------

DIRECT = 48  # larger groups are linked through shared neighbours
CROWD = 100_000  # still larger ones by Spark, a row for each neighbour
BROADCAST_ROWS = 1_000_000  # of crowded anchors, 8 bytes each


def _links_direct(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = [], []
    for lag in range(1, DIRECT):
        at = np.flatnonzero(group[lag:] == group[:-lag])
        if not len(at):
            break
        at = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= max_bits]
        left.append(at)
        right.append(at + lag)
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _masks(weight: int) -> list[int]:
    """All values of 64 bits with ``weight`` ones."""
    return [sum(1 << b for b in bits) for bits in combinations(range(64), weight)]


def _reach(max_bits: int) -> tuple[list[int], list[int]]:
    """Changes to a near neighbour, and those to a far one: two values are at most ``max_bits``
    apart if and only if a value is a near neighbour of one and a near or far one of the other."""
    near = [m for w in range(max_bits // 2 + 1) for m in _masks(w)]
    return near, _masks(max_bits // 2 + 1) if max_bits % 2 else []


def _links_shared(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect exactly the values at most ``max_bits`` apart, through neighbours."""
    near, far = _reach(max_bits)
    value = (fp[:, None] ^ np.array([*near, *far], dtype=np.uint64)).ravel()
    away = np.tile(np.arange(len(near) + len(far)) >= len(near), len(fp))
    owner = np.repeat(np.arange(len(fp)), len(near) + len(far))
    order = np.lexsort((away, value))
    first = np.flatnonzero(np.concatenate([[True], value[order][1:] != value[order][:-1]]))
    head = np.repeat(first, np.diff(np.append(first, len(order))))  # a near neighbour, if the value has one
    linked = np.flatnonzero((head != np.arange(len(order))) & ~away[order][head])
    return owner[order][head[linked]], owner[order][linked]


def _least_linked(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n nodes the least index of its component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def stars(anchor: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of equal (sorted) anchors, as (value, least value of component)."""
    fp = fp.view(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    size = np.diff(np.concatenate([first, [len(anchor)]]))
    direct = size <= DIRECT
    few = np.flatnonzero(np.repeat(direct & (size > 1), size))
    out = []
    left, right = _links_direct(anchor[few], fp[few], max_bits)
    out.append((few, left, right))
    for k in np.flatnonzero(~direct):
        rows = np.arange(first[k], first[k] + size[k])
        out.append((rows, *_links_shared(fp[rows], max_bits)))
    values, leasts = [], []
    for rows, left, right in out:
        if len(left):
            least = _least_linked(len(rows), left, right)
            linked = np.flatnonzero(least != np.arange(len(rows)))
            values.append(fp[rows][linked])
            leasts.append(fp[rows][least[linked]])
    empty = np.zeros(0, dtype=np.uint64)
    return (np.concatenate([empty, *values]).view(np.int64), np.concatenate([empty, *leasts]).view(np.int64))


def _crowd_links(crowds: DataFrame, max_bits: int) -> DataFrame:
    """The links of :func:`stars` for anchors with very many values, spread over tasks.

    Every value sends a row to each of its neighbours; the values that meet at one are at most
    as many as its neighbours, and link to the least near one.
    """
    signed = lambda m: F.lit(m - (1 << 64) if m >> 63 else m).cast("long")
    near, far = ([F.col("fp").bitwiseXOR(signed(m)) for m in masks] for masks in _reach(max_bits))
    sent = [F.struct(v.alias("value"), F.lit(k).alias("away")) for k, values in enumerate((near, far)) for v in values]
    met = crowds.select("anchor", "fp", F.explode(F.array(*sent)).alias("at"))
    met = met.groupBy("anchor", "at.value").agg(F.collect_list("fp").alias("all"), F.min(F.when(F.col("at.away") == 0, F.col("fp"))).alias("v"))
    return met.where("v IS NOT NULL AND size(all) > 1").select(F.explode("all").alias("u"), "v").where("u <> v").distinct()


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Links (``u``, ``v``) that connect the distinct ``fp`` at most ``max_bits`` apart.

    Anchors with more than ``crowd`` values are linked by Spark rows instead of in one task, with the
    same components.
    """
    code_of = prints.sparkSession.sparkContext.broadcast(AnchorCode(max_bits))  # 2**11 rows of patterns

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for k in range(0, len(values), 1000):
                part = np.ascontiguousarray(values[k:k + 1000])
                rows, anchors = code_of.value.replicas(part)
                yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(part[rows])], names=["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, fp = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            anchor = np.concatenate([anchor, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False)])
            if len(anchor) >= 100_000:  # all but the last anchor, whose rows may go on
                cut = np.searchsorted(anchor, anchor[-1])
                if cut:
                    yield _links(anchor[:cut], fp[:cut])
                    anchor, fp = anchor[cut:], fp[cut:]
        if len(anchor):
            yield _links(anchor, fp)

    def _links(anchor, fp):
        u, v = stars(anchor, fp, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    # A fingerprint becomes some 75 rows: few bytes are dealt to many tasks before they grow.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = prints.select("fp").where("fp IS NOT NULL").distinct().repartition(tasks)
    replicas = written(distinct.mapInArrow(spread, "anchor long, fp long"), "replicas")
    crowded = written(replicas.groupBy("anchor").count().where(F.col("count") > crowd).select("anchor"), "crowds")
    n = crowded.count()
    some = replicas
    if n:
        few = F.broadcast(crowded) if n <= BROADCAST_ROWS else crowded
        some = replicas.join(few, "anchor", "left_anti")
    links = some.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare, "u long, v long")
    return links.union(_crowd_links(replicas.join(few, "anchor", "left_semi"), max_bits)) if n else links


def simhash_components(docs: DataFrame, keep: list[Column | str], width: int = SHINGLE_WORDS,
                       max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """``keep`` columns (``doc_id`` among them), ``fingerprint`` (hex), ``component_id`` and
    ``component``, which tells components apart even where ids repeat or are null."""
    rows = written(fingerprints(docs, keep, width, seed), "fingerprints")
    kept = [c for c in rows.columns if c != "fp"]
    nodes = connected_components(fingerprint_links(rows, max_bits), "u", "v").withColumnRenamed("node", "fp")
    known = (rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
             .join(nodes, "fp", "left").withColumn("component", F.coalesce("component", "fp")))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(least, "component").select(F.col("fp").alias("known_fp"), "component_id", "component")
    return (rows.join(named, F.col("fp") == F.col("known_fp"))
            .select(*kept, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component"))
