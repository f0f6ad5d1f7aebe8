"""Byte-level helpers shared by the operators of this package.

Texts arrive in tasks as Arrow batches. They are joined with line feeds into chunks of a few
hundred kilobytes, so that numpy works on long arrays without large temporaries; a longer
document is a chunk of its own and never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

CHUNK_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers: dict[int, np.ndarray] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def byte_table(word: range | list[int] | None = None, breaks: list[int] | None = None) -> np.ndarray:
    """For each byte its lower-cased (A-Z only) value, and 0 for bytes outside words.

    ``word`` lists the bytes that make words; ``breaks`` those that do not.
    """
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    if word is not None:
        outside = np.ones(256, dtype=bool)
        outside[list(word)] = False
        table[outside] = 0
    if breaks is not None:
        table[breaks] = 0
    return table


SPACES = [0x20, *range(0x09, 0x0E)]


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return column.fill_null("").cast(pa.binary()).to_pylist()


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first, last, bytes, starts): texts [first, last) joined by line feeds.

    ``starts`` has one entry more than texts; text i lies in bytes
    [starts[i], starts[i + 1] - 1).
    """
    first = size = 0
    for last, text in enumerate(texts):
        if last > first and size + len(text) > limit:
            yield _chunk(texts, first, last)
            first, size = last, 0
        size += len(text) + 1
    if texts:
        yield _chunk(texts, first, len(texts))


def _chunk(texts: list[bytes], first: int, last: int):
    part = texts[first:last]
    starts = np.zeros(len(part) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in part], out=starts[1:])
    data = np.frombuffer(b"\n".join(part) + b"\n", dtype=np.uint8)
    return first, last, data, starts


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers of an odd base (or of its inverse) modulo 2**64; grown on demand."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        base = np.uint64(pow(int(_BASE), -1, 1 << 64)) if inverse else _BASE
        grown = np.full(max(n, CHUNK_BYTES + 4096), base, dtype=np.uint64)
        grown[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(grown, out=grown)
        _powers[inverse] = have = grown
    return have[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: n + 1 values modulo 2**64."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans, equal for equal bytes wherever they stand."""
    with np.errstate(over="ignore"):
        return (prefix[end] - prefix[start]) * powers(len(prefix), inverse=True)[start]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit values (the last steps of splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def word_spans(lowered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-zero bytes."""
    inside = np.zeros(len(lowered) + 2, dtype=np.int8)
    inside[1:-1] = lowered != 0
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def held_out(doc_id: str = "doc_id"):
    """True for documents no label is learned from: crc32(doc_id as text) mod 5 is 0."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0
