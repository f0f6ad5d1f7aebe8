"""JSON values from files of any layout: a value a line, indented values, arrays, all of them mixed.

Files are cut into byte ranges. An automaton over brackets and quotes tells where values begin and
end; JSON allows no raw line feed in a string, so quotes are settled within a line and only
the bracket depth is carried on. What a range does to the depth is two numbers, the brackets it
closes and the brackets it leaves open, and these compose: a first pass over files of several
ranges sums them up, windows over the ranges of a file give each range its depth at the start,
and a second pass reads every range from there. A value belongs to the range of its first line;
its reader goes on past the range until the value closes, so no text is shuffled.

Files are listed by Spark and read through Arrow's file systems (local, HDFS, S3, GCS, Azure).
Compressed files are one range.

What stands between values is odd text and gives rows too, so that nothing is lost unseen:

* a line outside any value is a row of its own, JSON or not; blank lines are none;
* what follows a value on its line is a row of its own;
* a bracket that never closes does not swallow what follows: its line is a row of its own and
  reading goes on with the next line, likewise a closing bracket without an opening one;
* a value of more than :data:`LARGEST` bytes, which no VARIANT holds, is one row without text; in a
  compressed file so is what follows a bracket that never closes, once it is that long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

SPLIT_BYTES = 64 << 20
FILE_COST = 4 << 20  # opening a file counts as so many bytes when work is dealt out
READ_BYTES = 1 << 20
#: Fixed value: the most bytes a VARIANT holds.
LARGEST = 128 << 20
COMPRESSED = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}
MAX_TASKS = 100_000

_DELTA = np.zeros(256, dtype=np.int8)
_DELTA[list(b"{[")] = 1
_DELTA[list(b"}]")] = -1


# -- the automaton ---------------------------------------------------------------------


def bracket_steps(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """+1 and -1 at brackets outside strings; ``starts`` are the first bytes of the lines."""
    step = _DELTA[data].astype(np.int64)
    quote = data == 0x22
    slash = data == 0x5C
    if slash.any():
        at = np.arange(len(data))
        last = np.maximum.accumulate(np.where(slash, -1, at))
        quote[1:] &= (at[:-1] - last[:-1]) % 2 == 0  # an odd run of backslashes escapes the quote
    seen = np.cumsum(quote)
    before = np.concatenate([[0], seen])[starts]
    inside = (seen - np.repeat(before, np.diff(np.append(starts, len(data))))) % 2 == 1
    step[inside] = 0
    return step


@dataclass
class Lines:
    """Whole lines with the brackets each closes and leaves open, and how often it is back at its lowest."""

    texts: list[bytes]
    closes: np.ndarray
    opens: np.ndarray
    returns: np.ndarray

    @classmethod
    def of(cls, block: bytes) -> Lines:
        """``block`` holds whole lines; the last may lack its line feed."""
        block = block if block.endswith(b"\n") else block + b"\n"
        data = np.frombuffer(block, dtype=np.uint8)
        starts = np.concatenate([[0], np.flatnonzero(data == 0x0A)[:-1] + 1])
        step = bracket_steps(data, starts)
        depth = np.cumsum(step)
        before = np.concatenate([[0], depth])[starts]
        low = np.minimum(before, np.minimum.reduceat(depth, starts))
        after = np.append(depth[starts[1:] - 1], depth[-1])
        sizes = np.diff(np.append(starts, len(data)))
        returns = np.add.reduceat(((step < 0) & (depth == np.repeat(low, sizes))).astype(np.int64), starts)
        return cls(block[:-1].split(b"\n"), before - low, after - low, returns)

    def __getitem__(self, at: slice) -> Lines:
        return Lines(self.texts[at], self.closes[at], self.opens[at], self.returns[at])

    def __add__(self, more: Lines) -> Lines:
        return Lines(self.texts + more.texts, *(np.concatenate([getattr(self, c), getattr(more, c)])
                                                for c in ("closes", "opens", "returns")))


def composed(closes: np.ndarray, opens: np.ndarray) -> tuple[int, int]:
    """What several lines or ranges do one after the other: brackets closed, brackets left open."""
    total = np.cumsum(opens - closes)
    low = min(0, int((np.concatenate([[0], total[:-1]]) - closes).min(initial=0)))
    return -low, int(total[-1] if len(total) else 0) - low


def depths(lines: Lines, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(lowest depth in, depth after) each line; a closing bracket at depth 0 leaves it at 0."""
    total = start + np.cumsum(lines.opens - lines.closes)
    low = np.concatenate([[start], total[:-1]]) - lines.closes
    after = total - np.minimum(0, np.minimum.accumulate(low)) if len(low) else total
    return np.maximum(np.concatenate([[start], after[:-1]]) - lines.closes, 0), after


def split_values(text: bytes) -> list[bytes]:
    """Values and odd text of a piece that begins outside any value."""
    data = np.frombuffer(text + b"\n", dtype=np.uint8)
    step = bracket_steps(data, np.concatenate([[0], np.flatnonzero(data == 0x0A)[:-1] + 1]))
    depth = np.cumsum(step)
    depth = depth - np.minimum(0, np.minimum.accumulate(depth))
    ends = [*(np.flatnonzero((step < 0) & (depth == 0)) + 1).tolist(), len(text)]
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def rest_of_line(line: bytes, depth: int, base: int) -> bytes:
    """What follows the closing bracket that brings ``depth`` down to ``base``."""
    data = np.frombuffer(line + b"\n", dtype=np.uint8)
    at = np.flatnonzero(depth + np.cumsum(bracket_steps(data, np.zeros(1, dtype=np.int64))) <= base)
    return line[at[0] + 1:] if len(at) else b""


# -- reading a range -------------------------------------------------------------------


def _file(path: str):
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1))


def line_blocks(path: str, start: int) -> Iterator[tuple[int, bytes]]:
    """(offset, whole lines) from the first line that begins at ``start`` or later.

    A line longer than :data:`LARGEST` comes as a single byte that is no JSON.
    """
    files, name = _file(path)
    kind = next((c for suffix, c in COMPRESSED.items() if name.endswith(suffix)), None)
    with (files.open_input_stream(name, compression=kind) if kind else files.open_input_file(name)) as stream:
        offset, held, gone, skipping = start, b"", 0, start > 0
        if start:
            stream.seek(start - 1)
            offset = start - 1
        while piece := stream.read(READ_BYTES):
            held += piece
            if skipping or gone:
                end = held.find(b"\n") + 1
                if not end:
                    offset, gone, held = (offset + len(held), 0, b"") if skipping else (offset, gone + len(held), b"")
                    continue
                if gone:
                    yield offset, b"\x00\n"
                offset, held, gone, skipping = offset + gone + end, held[end:], 0, False
            end = held.rfind(b"\n") + 1
            if end:
                yield offset, held[:end]
                offset, held = offset + end, held[end:]
            if len(held) > LARGEST:
                gone, held = len(held), b""
        if gone or held:
            yield offset, b"\x00" if gone else held


def own_blocks(blocks: Iterator[tuple[int, bytes]], end: int | None) -> Iterator[tuple[bytes, bytes]]:
    """(lines that begin before ``end``, lines of the same block after it); stops after the latter."""
    for offset, block in blocks:
        if end is None or offset + len(block) <= end:
            yield block, b""
            continue
        if offset >= end:
            yield b"", block
            return
        cut = block.find(b"\n", end - offset - 1) + 1 or len(block)
        yield block[:cut], block[cut:]
        return


def range_values(path: str, start: int, end: int | None, depth: int, base: int, later: int | None,
                 largest: int = LARGEST) -> Iterator[bytes | None]:
    """The values whose first line begins in the range; None for one that is too long.

    ``depth`` is the bracket depth at the start, ``base`` the lowest depth from there to the
    end of the file, ``later`` the lowest depth after the range (None where nothing follows).
    """
    blocks = line_blocks(path, start)
    lines, held, beyond = Lines([], *[np.zeros(0, dtype=np.int64)] * 3), 0, b""
    before = depth  # of the first line held
    inside = depth > base  # a value of an earlier range is still open
    dropped = False  # the value in hand is too long to be kept
    for own, beyond in own_blocks(blocks, end):
        if not own:
            break
        lines = lines + Lines.of(own)
        held += len(own)
        dips, after = depths(lines, before)
        if inside:
            at = np.flatnonzero(dips <= base)
            if not len(at):
                before, lines, held = int(after[-1]), lines[:0], 0
                continue
            first = int(at[0])
            rest = rest_of_line(lines.texts[first], int(after[first - 1]) if first else before, base)
            lines = Lines.of(rest) + lines[first + 1:]
            before, inside = base, False
            dips, after = depths(lines, before)
        settled = np.flatnonzero(after <= base)
        if len(settled):
            done = int(settled[-1]) + 1
            yield from _records(lines[:done], dips[:done], after[:done], after[:done] <= base, before, dropped)
            before, dropped = int(after[done - 1]), False
            lines = lines[done:]
            held = sum(map(len, lines.texts))
        if held > largest:
            before, lines, held, dropped = int(after[-1]), lines[:0], 0, True
    if dropped:
        yield None
        return
    if inside or not lines.texts:
        return
    # Lines that are left lie above the lowest depth so far: what is never closed is told by what follows.
    dips, after = depths(lines, before)
    floor = int(after[-1]) if later is None else min(later, int(after[-1]))
    lowest = np.minimum(np.append(np.minimum.accumulate(dips[:0:-1])[::-1], floor), floor)
    ends = after <= lowest
    open_from = int(np.flatnonzero(ends)[-1]) + 1 if ends.any() else 0
    yield from _records(lines[:open_from], dips[:open_from], after[:open_from], ends[:open_from], before, False)
    if open_from < len(ends):
        level = max(floor, int(after[open_from - 1]) if open_from else before)
        text = _finished(lines.texts[open_from:], int(after[-1]), level, beyond, blocks, largest)
        yield from [None] if text is None else filter(None, map(bytes.strip, split_values(text)))


def _finished(text: list[bytes], depth: int, base: int, beyond: bytes, blocks: Iterator[tuple[int, bytes]],
              largest: int) -> bytes | None:
    """Open text with the lines after the range, up to the bracket that brings ``depth`` to ``base``."""
    size = sum(map(len, text))
    while size <= largest:
        more = Lines.of(beyond) if beyond else None
        if more:
            dips, after = depths(more, depth)
            at = np.flatnonzero(dips <= base)
            if len(at):
                last = int(at[0])
                line = more.texts[last]
                rest = rest_of_line(line, int(after[last - 1]) if last else depth, base)
                return b"\n".join([*text, *more.texts[:last], line[:len(line) - len(rest)]])
            text, size, depth = text + more.texts, size + len(beyond), int(after[-1])
        beyond = next(blocks, (0, b""))[1]
        if not beyond:
            return b"\n".join(text)
    return None


def _records(lines: Lines, dips, after, ends, before: int, dropped: bool) -> Iterator[bytes | None]:
    """Lines grouped up to each end; a group is one value, several, or odd text."""
    start = 0
    for end in np.flatnonzero(ends).tolist():
        group = lines.texts[start:end + 1]
        base = before if not start else int(after[start - 1])
        if dropped and not start:  # the head of this value was not kept
            yield None
            group = [rest_of_line(group[-1], int(after[end - 1]) if end else before, int(after[end]))]
            plain = False
        elif len(group) == 1:
            closed = lines.returns[end] == 1 and not lines.opens[end] and group[0].rstrip().endswith((b"}", b"]"))
            plain = not lines.closes[end] and (not lines.returns[end] or closed)
        else:
            plain = (lines.returns[start] == lines.closes[start] == 0 and lines.returns[end] == 1 and (dips[start:end] > base)[1:].all()
                     and after[end] == base == after[end - 1] - lines.closes[end] and group[-1].rstrip().endswith((b"}", b"]")))
        text = b"\n".join(group)
        for value in [text] if plain else split_values(text):
            if value := value.strip():
                yield value
        start = end + 1


# -- tables ----------------------------------------------------------------------------


def file_ranges(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``source_file, start, end``: byte ranges of listed files; ``end`` is null in a file's last range."""
    whole = F.lit(False)
    for suffix in COMPRESSED:
        whole = whole | F.col("source_file").endswith(suffix)
    first = F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    ranges = files.select("source_file", F.when(whole, 0).otherwise(F.col("length")).alias("length"), F.explode(first).alias("start"))
    end = F.col("start") + split_bytes
    return ranges.select("source_file", "start", F.when(end < F.col("length"), end).alias("end"))


def range_effects(ranges: DataFrame) -> DataFrame:
    """``source_file, start, closes, opens``: what each range does to the bracket depth."""

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = []
                for own, _ in own_blocks(line_blocks(row["source_file"], row["start"]), row["end"]):
                    if own:
                        lines = Lines.of(own)
                        parts.append(composed(lines.closes, lines.opens))
                closes, opens = composed(*np.array(parts, dtype=np.int64).reshape(-1, 2).T)
                yield pa.RecordBatch.from_arrays([pa.array([row["source_file"]]), pa.array([row["start"]]),
                                                  pa.array([closes]), pa.array([opens])],
                                                 names=["source_file", "start", "closes", "opens"])

    return ranges.mapInArrow(effects, "source_file string, start long, closes long, opens long")


def range_depths(effects: DataFrame) -> DataFrame:
    """``source_file, start, depth, base, later`` from the effects of a file's ranges.

    A window holds the ranges of one file, a row for each ``split_bytes`` of it.
    """
    order = Window.partitionBy("source_file").orderBy("start")
    following = order.rowsBetween(1, Window.unboundedFollowing)
    total = F.sum(F.col("opens") - F.col("closes")).over(order)
    summed = effects.withColumn("total", total).withColumn("low", F.col("total") - F.col("opens"))
    after = F.col("total") - F.least(F.lit(0), F.min("low").over(order))
    known = summed.withColumn("after", after).withColumn("depth", F.coalesce(F.lag("after").over(order), F.lit(0)))
    known = known.withColumn("dip", F.greatest(F.col("depth") - F.col("closes"), F.lit(0)))
    known = known.withColumn("later", F.min("dip").over(following))
    return known.select("source_file", "start", "depth", F.least("dip", "later", "after").alias("base"), "later")


def read_values(spark: SparkSession, files: DataFrame, *, split_bytes: int = SPLIT_BYTES, largest: int = LARGEST) -> DataFrame:
    """``value binary, source_file``: a row per JSON value or piece of odd text in the listed files.

    ``files`` has ``source_file`` and ``length`` (``sources.landing.list_files``). The value is
    null where it is longer than ``largest``.
    """
    ranges = file_ranges(files, split_bytes)
    work = files.agg(F.sum(F.col("length") + FILE_COST).alias("work")).first()["work"] or 0
    tasks = max(1, min(MAX_TASKS, -(-work // max(split_bytes, SPLIT_BYTES))), min(spark.sparkContext.defaultParallelism, work // FILE_COST))
    several = F.col("end").isNotNull() | (F.col("start") > 0)
    states = range_depths(range_effects(ranges.where(several).repartition(tasks)))
    dealt = ranges.join(states, ["source_file", "start"], "left").repartition(tasks)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                name, held, size = row["source_file"], [], 0
                for value in range_values(name, row["start"], row["end"], row["depth"] or 0, row["base"] or 0,
                                          row["later"], largest):
                    held.append(value)
                    size += len(value or b"")
                    if size > READ_BYTES:
                        yield _value_batch(held, name)
                        held, size = [], 0
                yield _value_batch(held, name)

    return dealt.mapInArrow(values, "value binary, source_file string")


def _value_batch(values: list[bytes | None], name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), pa.array([name] * len(values), pa.string())],
                                      names=["value", "source_file"])
