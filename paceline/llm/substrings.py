"""Exact substring duplicates by a hash-compared suffix sort.

A byte goes if it lies in a string of ``LENGTH`` bytes that starts anywhere else as well. Every
such string holds an anchor: the leftmost smallest hash of its ``GRAM``-byte grams, the same in
every copy. So only suffixes at anchors are sorted, about one in 170.

1. Anchors of all documents are written with a hash of the gram and one of their context, all
   bytes that strings around this anchor can reach.
2. Equal contexts are counted. Where one comes twice, all strings in it are repeated.
3. Where a gram stands in different contexts, one row for each context gets its bytes. In tasks
   the suffixes at a gram's anchors are merge-sorted, and so are the reversed prefixes; two are
   compared by a binary search for their common extension over prefix polynomial hashes. The
   neighbours in either order bound how far strings can reach; where the bound is not met, the
   strings themselves are looked up by hash. All reaches found are verified byte by byte.
4. Reaches become byte ranges of documents, which are cut out.

A gram with more contexts than ``GROUP`` is not sorted in one task: its strings are counted by
hash in the cluster, which gives the same reaches.

Defined results: null and empty texts and those shorter than ``LENGTH`` lose nothing; repeated
rows are copies of each other and lose everything that is long enough; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from paceline.llm import common
from paceline.sources.scratch import written

LENGTH, GRAM = 400, 64
GROUP = 50_000  # contexts of one gram that a task sorts: 37 MB of bytes, 300 MB of hashes
_ROWS = 4_000  # contexts sorted at a time, but for a larger group


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every window, by running minima from both sides of blocks."""
    n = len(x)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    full[:n] = x
    full = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the chunk, gram hash) of every anchor of a chunk of texts."""
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    size = np.diff(starts) - 1
    if len(data) < length or size.max(initial=0) < length:
        return none
    prefix = common.prefix_hashes(data)
    at = np.arange(len(data) - gram + 1)
    h = common.mixed(common.span_hashes(prefix, at, at + gram))
    low = np.uint64(32)
    least = _window_minima((h >> low << low) | at.astype(np.uint64), length - gram + 1)
    owner = np.repeat(np.arange(len(size)), size + 1)[:len(least)]
    begins = np.arange(len(least))
    inside = begins + length <= starts[owner + 1] - 1  # strings within one text
    place = (least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = owner[inside]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], place[new], h[place[new]]


def _anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``gram, context, doc_id, key, n_bytes, place`` of all anchors; key and n_bytes tell texts apart."""
    rows = docs.select("doc_id", "text")
    reach = length - gram

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            texts = common.texts_of(batch.column(1))
            for first, _, data, starts in common.chunks(texts):
                owner, place, h = anchors(data, starts, length, gram)
                if not len(owner):
                    continue
                raw = data.tobytes()
                begin, end = starts[owner], starts[owner + 1] - 1
                low, high = np.maximum(begin, place - reach), np.minimum(end, place + length)
                context = [digest(raw[a:b], p - a) for a, b, p in zip(low.tolist(), high.tolist(), place.tolist())]
                keys = {k: digest(texts[first + k], 42) for k in np.unique(owner).tolist()}
                key = np.array([keys[k] for k in owner.tolist()], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(np.array(context, dtype=np.uint64).view(np.int64)),
                     batch.column(0).take(pa.array(owner + first)), pa.array(key),
                     pa.array((end - begin).astype(np.int32)), pa.array((place - begin).astype(np.int32))], names=names)

    names = ["gram", "context", "doc_id", "key", "n_bytes", "place"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(found, f"gram long, context long, doc_id {kind}, key long, n_bytes int, place int")


# -- sorting suffixes in a task ------------------------------------------------------------


class Suffixes:
    """Contexts of a task as one byte array; each has an anchor place and its own prefix hashes."""

    def __init__(self, contexts: list[bytes], left: np.ndarray):
        self.raw = b"".join(contexts)
        self.data = np.frombuffer(self.raw, dtype=np.uint8)
        size = np.array([len(c) for c in contexts], dtype=np.int64)
        self.end = np.cumsum(size)
        self.begin = self.end - size
        self.left = left.astype(np.int64)
        self.place = self.begin + self.left
        self.right = self.end - self.place
        self.prefix = np.zeros(len(self.data) + len(size), dtype=np.uint64)  # one 0 more for each context
        self.at = self.place + np.arange(len(size))
        most = int(size.max(initial=0)) + 1
        power, self.inverse = common.powers(most), common.powers(most, inverse=True)
        for k in range(0, len(size), 512):  # in parts, so that temporaries stay small
            part = size[k:k + 512]
            first = int(self.begin[k])
            inside = np.arange(int(part.sum())) - np.repeat(np.cumsum(part) - part, part)
            with np.errstate(over="ignore"):
                run = np.cumsum((self.data[first:first + len(inside)] + np.uint64(1)) * power[inside])
                before = np.concatenate([np.zeros(1, dtype=np.uint64), run])[np.cumsum(part) - part]
                run -= np.repeat(before, part)
            self.prefix[first + np.arange(len(inside)) + k + np.repeat(np.arange(len(part)), part) + 1] = run

    def span(self, i: np.ndarray, low, high) -> np.ndarray:
        """Hashes of the bytes from ``low`` to ``high``, counted from the anchors."""
        with np.errstate(over="ignore"):
            return (self.prefix[self.at[i] + high] - self.prefix[self.at[i] + low]) * self.inverse[self.left[i] + low]

    def common_extension(self, i: np.ndarray, j: np.ndarray, backward: bool) -> np.ndarray:
        """The longest common extension of two suffixes (or of the reversed prefixes)."""
        reach = self.left if backward else self.right
        high = np.minimum(reach[i], reach[j])
        low = np.zeros_like(high)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            half = (low[open_] + high[open_] + 1) // 2
            ends = (-half, 0) if backward else (0, half)
            same = self.span(i[open_], *ends) == self.span(j[open_], *ends)
            low[open_] = np.where(same, half, low[open_])
            high[open_] = np.where(same, high[open_], half - 1)

    def before(self, i: np.ndarray, j: np.ndarray, backward: bool) -> np.ndarray:
        """Whether suffix i sorts before suffix j; a prefix of the other, then the number, decides ties."""
        n = self.common_extension(i, j, backward)
        reach = self.left if backward else self.right
        ended = (n >= reach[i]) | (n >= reach[j])
        step = np.where(ended, 0, n)
        if backward:
            x, y = self.place[i] - 1 - step, self.place[j] - 1 - step
        else:
            x, y = self.place[i] + step, self.place[j] + step
        last = len(self.data) - 1
        x, y = self.data[x.clip(0, last)], self.data[y.clip(0, last)]
        tie = (reach[i] < reach[j]) | ((reach[i] == reach[j]) & (i < j))
        return np.where(ended, tie, x < y)

    def sorted(self, group: np.ndarray, backward: bool) -> np.ndarray:
        """Suffix numbers in sorted order within each group (equal numbers stand together).

        A merge sort of all groups at once: an element's place in a merged run is its place in
        its own run plus the number of elements of the other run before it, found by bisection.
        """
        n = len(group)
        order = np.arange(n)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.concatenate([first, [n]]))
        start, stop = np.repeat(first, size), np.repeat(first + size, size)
        width = 1
        while width < size.max(initial=0):
            at = np.flatnonzero(stop - start > width)
            run = (at - start[at]) // width
            other_low = start[at] + (run ^ 1) * width
            low = np.minimum(other_low, stop[at])
            high = np.minimum(other_low + width, stop[at])
            bottom = low.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                smaller = self.before(order[middle], order[at[open_]], backward)
                low[open_] = np.where(smaller, middle + 1, low[open_])
                high[open_] = np.where(smaller, high[open_], middle)
            target = start[at] + (run & ~1) * width + (at - start[at] - run * width) + (low - bottom)
            merged = order.copy()
            merged[target] = order[at]
            order = merged
            width *= 2
        return order


def reaches(contexts: list[bytes], left: np.ndarray, group: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """How far repeated strings reach left and right of each anchor; 0, 0 where there is none.

    Contexts of a group (numbers stand together) are different and share the anchor's gram.
    """
    s = Suffixes(contexts, left)
    n = len(contexts)
    partners = []
    bound = {}
    for backward in (False, True):
        order = s.sorted(group, backward)
        beside = np.flatnonzero(group[order][1:] == group[order][:-1])
        i, j = order[beside], order[beside + 1]
        most = np.zeros(n, dtype=np.int64)
        shared = s.common_extension(i, j, backward)
        np.maximum.at(most, i, shared)
        np.maximum.at(most, j, shared)
        bound[backward] = most
        partners += [(i, j), (j, i)]
    to_left, to_right = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    left_of, right_of = np.full(n, -1), np.full(n, -1)
    for i, j in partners:  # each suffix at most once in i
        a, b = s.common_extension(i, j, True), s.common_extension(i, j, False)
        fits = a + b >= length
        for reach, best, who in ((a, to_left, left_of), (b, to_right, right_of)):
            more = np.flatnonzero(fits & (reach > best[i]))
            best[i[more]], who[i[more]] = reach[more], j[more]
    unsure = (bound[True] + bound[False] >= length) & ((to_left < bound[True]) | (to_right < bound[False]))
    open_groups = np.isin(group, np.unique(group[unsure]))
    verified = _same_bytes(s, to_left, to_right, left_of, right_of, length)
    if open_groups.any() or not verified.all():
        rows = np.flatnonzero(open_groups | np.isin(group, np.unique(group[~verified])))
        found = _looked_up(s, rows, group[rows], length)
        if found is None:  # hashes collide: look the strings themselves up
            found = _looked_up_exactly(s, rows, group[rows], length)
        to_left[rows], to_right[rows] = found
    return to_left, to_right


def _same_bytes(s: Suffixes, to_left, to_right, left_of, right_of, length: int) -> np.ndarray:
    """Whether the reaches taken from hashes hold byte by byte."""
    ok = np.ones(len(to_left), dtype=bool)
    raw, place = s.raw, s.place.tolist()
    for i in np.flatnonzero(left_of >= 0).tolist():
        p, n = place[i], int(to_left[i])
        q, m = place[left_of[i]], length - int(to_left[i])
        ok[i] = raw[p - n:p + m] == raw[q - n:q + m]
        n = int(to_right[i])
        q, m = place[right_of[i]], length - int(to_right[i])
        ok[i] &= raw[p - m:p + n] == raw[q - m:q + n] if m > 0 else raw[p:p + n] == raw[q:q + n]
    return ok


def _looked_up(s: Suffixes, rows: np.ndarray, group: np.ndarray, length: int):
    """Reaches by looking up every string around the anchors by hash; None if hashes collide."""
    to_left, to_right = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
    number = np.unique(group, return_inverse=True)[1].astype(np.uint64)
    salt = common.mixed(number + np.uint64(1))
    for shift in range(int(s.left[rows].max(initial=0)) + 1):
        at = np.flatnonzero((s.left[rows] >= shift) & (s.right[rows] >= length - shift))
        if len(at) < 2:
            continue
        begin = s.place[rows[at]] - shift
        h = s.span(rows[at], -shift, length - shift) ^ salt[at]
        order = np.argsort(h, kind="stable")
        same = np.flatnonzero(h[order][1:] == h[order][:-1])
        x, y = at[order[same]], at[order[same + 1]]
        for i, j in zip(begin[order[same]].tolist(), begin[order[same + 1]].tolist()):
            if s.raw[i:i + length] != s.raw[j:j + length]:
                return None
        for hit in (x, y):
            to_left[hit] = np.maximum(to_left[hit], shift)
            to_right[hit] = np.maximum(to_right[hit], length - shift)
    return to_left, to_right


def _looked_up_exactly(s: Suffixes, rows: np.ndarray, group: np.ndarray, length: int):
    to_left, to_right = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
    for shift in range(int(s.left[rows].max(initial=0)) + 1):
        seen: dict[tuple[int, bytes], list[int]] = {}
        for k in np.flatnonzero((s.left[rows] >= shift) & (s.right[rows] >= length - shift)).tolist():
            begin = int(s.place[rows[k]]) - shift
            seen.setdefault((int(group[k]), s.raw[begin:begin + length]), []).append(k)
        for hit in seen.values():
            if len(hit) > 1:
                to_left[hit] = np.maximum(to_left[hit], shift)
                to_right[hit] = np.maximum(to_right[hit], length - shift)
    return to_left, to_right


# -- the job -------------------------------------------------------------------------------


def text_key(text: str = "text") -> Column:
    """The hash that :func:`_anchor_rows` computes in tasks (XXH64, seed 42)."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


_OF_TEXT = ["doc_id", "key", "n_bytes"]


def _same_text(left: str, right: str) -> Column:
    return (F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.key") == F.col(f"{right}.key"))
            & (F.col(f"{left}.n_bytes") == F.col(f"{right}.n_bytes")))


def _with_bytes(variants: DataFrame, docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Each context's bytes, cut from one text that holds it."""
    lists = variants.groupBy(*_OF_TEXT).agg(F.collect_list(F.struct("gram", "context", "n", "m", "place")).alias("places"))
    rows = docs.alias("d").join(lists.alias("l"), _same_text("d", "l")).select("d.doc_id", "d.key", "d.n_bytes", "text", "places")
    kind = variants.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.texts_of(batch.column(3))
            for k in range(batch.num_rows):
                places = batch.column(4).slice(k, 1).flatten()
                place = places.field("place").to_pylist()
                low = [max(0, p - (length - gram)) for p in place]
                same = [batch.column(c).slice(k, 1).take(pa.array([0] * len(place))) for c in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [places.field("gram"), places.field("context"), places.field("n"), places.field("m"), *same, places.field("place"),
                     pa.array([p - a for p, a in zip(place, low)], pa.int32()),
                     pa.array([texts[k][a:p + length] for a, p in zip(low, place)], pa.binary())],
                    names=["gram", "context", "n", "m", *_OF_TEXT, "place", "left", "bytes"])

    return rows.mapInArrow(cut, f"gram long, context long, n long, m long, doc_id {kind}, key long, n_bytes int, "
                                "place int, left int, bytes binary")


def _sorted_reaches(contexts: DataFrame, length: int) -> DataFrame:
    """Ranges of texts from contexts sorted by gram in tasks."""
    kind = contexts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key long, n_bytes int, low int, high int"

    def solve(table: pa.Table) -> pa.RecordBatch:
        gram = table.column("gram").to_numpy()
        context = table.column("context").to_numpy()
        keep = np.ones(len(gram), dtype=bool)  # a repeated row of documents brings its contexts twice
        keep[1:] = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
        table = table.take(pa.array(np.flatnonzero(keep))).combine_chunks()
        left = table.column("left").to_numpy()
        to_left, to_right = reaches(table.column("bytes").to_pylist(), left, gram[keep], length)
        at = np.flatnonzero((to_left + to_right >= length) & (table.column("n").to_numpy() == 1))
        place = table.column("place").to_numpy()[at]
        same = table.select(_OF_TEXT).take(pa.array(at)).combine_chunks()
        columns = [same.column(c).combine_chunks() if same.num_rows else pa.array([], same.schema.field(c).type) for c in _OF_TEXT]
        columns = [c if not isinstance(c, pa.ChunkedArray) else pa.concat_arrays(c.chunks) for c in columns]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array((place - to_left[at]).astype(np.int32)), pa.array((place + to_right[at]).astype(np.int32))],
            names=[*_OF_TEXT, "low", "high"])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            if waiting.num_rows >= _ROWS:  # all but the last gram, whose rows may go on
                gram = waiting.column("gram").to_numpy()
                cut = int(np.searchsorted(gram, gram[-1]))
                if cut:
                    yield solve(waiting.slice(0, cut))
                    waiting = waiting.slice(cut)
        if waiting is not None and waiting.num_rows:
            yield solve(waiting)

    return contexts.repartition("gram").sortWithinPartitions("gram", "context").mapInArrow(tasks, schema)


def _counted_reaches(contexts: DataFrame, length: int) -> DataFrame:
    """The same ranges for grams with very many contexts: strings counted by hash."""
    kind = contexts.schema["doc_id"].dataType.simpleString()
    rows = contexts.dropDuplicates(["gram", "context"])

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, all_bytes = batch.column(8).to_pylist(), batch.column(9).to_pylist()
            for k in range(batch.num_rows):
                shifts = [d for d in range(left[k] + 1) if len(all_bytes[k]) - left[k] >= length - d]
                h = [xxhash.xxh3_128_digest(all_bytes[k][left[k] - d:left[k] - d + length]) for d in shifts]
                same = [batch.column(c).slice(k, 1).take(pa.array([0] * len(h))) for c in (0, 1, 2, 4, 5, 6, 7)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(shifts, pa.int32()), pa.array(h, pa.binary())], names=names)

    names = ["gram", "context", "n", *_OF_TEXT, "place", "shift", "string"]
    every = written(rows.mapInArrow(strings, f"gram long, context long, n long, doc_id {kind}, key long, n_bytes int, "
                                             "place int, shift int, string binary"), "strings")
    often = (every.groupBy("gram", "string").agg(F.count("*").alias("times")).where("times > 1")
             .select(F.col("gram").alias("g"), F.col("string").alias("s")))
    hit = every.where("n = 1").join(often, (F.col("gram") == F.col("g")) & (F.col("string") == F.col("s")))
    return (hit.groupBy("gram", "context", *_OF_TEXT, "place")
            .agg((F.max("shift")).alias("l"), (F.lit(length) - F.min("shift")).alias("r"))
            .select(*_OF_TEXT, (F.col("place") - F.col("l")).cast("int").alias("low"),
                    (F.col("place") + F.col("r")).cast("int").alias("high")))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``doc_id, key, n_bytes, low, high``: byte ranges covered by repeated strings; they overlap.

    ``docs`` has doc_id, text, key and n_bytes.
    """
    docs = docs.where(F.col("n_bytes") >= length)
    found = written(_anchor_rows(docs, length, gram), "anchors")
    one = [F.first(c).alias(c) for c in (*_OF_TEXT, "place")]  # all of one row, any of the equal contexts
    classes = written(found.groupBy("gram", "context").agg(F.count("*").alias("n"), *one), "contexts")
    several = classes.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1").withColumnRenamed("gram", "g")
    variants = classes.join(several, F.col("gram") == F.col("g")).drop("g")
    contexts = written(_with_bytes(variants, docs, length, gram), "context-bytes")
    sorted_ = _sorted_reaches(contexts.where(F.col("m") <= group), length)
    counted = _counted_reaches(contexts.where(F.col("m") > group), length)

    often = classes.where("n > 1").select(F.col("gram").alias("g"), F.col("context").alias("c"))
    whole = found.join(often, (F.col("gram") == F.col("g")) & (F.col("context") == F.col("c"))).select(
        *_OF_TEXT, F.greatest(F.lit(0), F.col("place") - (length - gram)).cast("int").alias("low"),
        F.least(F.col("n_bytes"), F.col("place") + length).cast("int").alias("high"))
    return whole.union(sorted_).union(counted)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes that stay)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), text_key().alias("key"), F.octet_length(text).alias("n_bytes"))
    ranges = repeated_ranges(rows, length, gram, group)
    lists = ranges.groupBy(*_OF_TEXT).agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    joined = rows.alias("d").join(lists.alias("l"), _same_text("d", "l"), "left").select("d.doc_id", "text", "ranges")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed, spans, kept = common.texts_of(batch.column(1)), [], [], []
            for raw, found in zip(texts, batch.column(2).to_pylist()):
                merged = _merged([(r["low"], r["high"]) for r in found or ()])
                edges = [0, *(e for r in merged for e in r), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                removed.append(len(raw) - len(kept[-1]))
                spans.append(len(merged))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
