"""Benchmark decontamination by template windows.

Texts are canonicalised to templates: numbers, units after numbers and names (capitalised words
inside a sentence) become typed placeholders, all other words are lower-cased. Windows of
``WINDOW`` template words are hash-joined between documents and benchmark items; the words
behind the placeholders travel along as slots. Literal windows, of the lower-cased words
themselves, are joined beside them: they find copies in other case and items dense in slots.
Items of less than three windows also have narrower windows, so that two changes at the thirds
leave some in each; items of less than one window are one literal window.

Windows are put together by document, item and shift, and also over the shifts of a range as
long as the item, as inserted and deleted words move the rest. The document holds the item if
such a group covers enough of its words and the slots are consistent, that is every benchmark
value has one replacement throughout.

Only windows that may match leave the document scan: a bitmap of the benchmark's window hashes,
of fixed size whatever the benchmark, is tested in the tasks; it can only let too many through,
and the join decides.

A window that many items share ("answer the following question about the") is not joined with all of
them: an item that its common windows alone cannot cover far enough is looked at in a document only
if the document has one of its rarer windows, and then with all its windows. The result is the same.

Defined results: null and empty texts hold nothing; items of fewer than ``WINDOW`` words are held
by documents with all their words in a row, in any case; template windows with fewer than
``WINDOW / 2`` literal words are not used; a group covers ``WINDOW`` words at least, and coverage
is the share of the item's words or, if higher, of those in its template windows; repeated rows
get equal results; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paceline.llm import common
from paceline.sources.scratch import written

WINDOW, COVERAGE = 8, 0.5
COMMON = 16  # a window of more items than this is a common one
BITMAP_BITS = 22
#: Unit words that follow a number.
UNITS = ("mm", "cm", "m", "km", "mi", "ft", "in", "inch", "inches", "miles", "meters", "metres", "mg", "g", "kg", "lb",
         "lbs", "oz", "ml", "l", "liters", "litres", "s", "sec", "seconds", "min", "minutes", "h", "hours", "days",
         "weeks", "months", "years", "usd", "eur", "gbp", "dollars", "euros", "pounds", "cents", "percent", "degrees",
         "kb", "mb", "gb", "w", "kw", "v", "hz", "khz", "mhz", "mph", "kmh")

_WORD = common.byte_table(word=[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_NUMBER, _NAME, _UNIT = np.uint64(0x6E756D), np.uint64(0x6E616D), np.uint64(0x756E69)
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


def _is(data: np.ndarray, low: int, high: int) -> np.ndarray:
    return (data >= low) & (data <= high)


class Templates:
    """The template words of a chunk: hash and kind of each word, and its bytes' place."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        lowered = _WORD[data]
        latin = np.flatnonzero((data[:-1] == 0xC3) & _is(data[1:], 0x80, 0x9E) & (data[1:] != 0x97)) + 1
        lowered[latin] += 0x20  # capital letters of Latin-1
        digit = _is(data, 0x30, 0x39)
        point = (data == 0x2E) | (data == 0x2C)
        inner = np.zeros(len(data), dtype=bool)  # 3.5 and 1,000 are one number
        inner[1:-1] = point[1:-1] & digit[:-2] & digit[2:]
        lowered[inner] = data[inner]
        self.begin, self.end = common.word_spans(lowered)
        self.first = np.searchsorted(self.begin, starts)
        b, e, n = self.begin, self.end, len(self.begin)
        h = common.mixed(common.span_hashes(common.prefix_hashes(lowered), b, e))

        number = digit[b] if n else np.zeros(0, dtype=bool)
        ended = np.concatenate([[0], np.cumsum(_ENDS[data])])
        opening = np.ones(n, dtype=bool)  # first word of a sentence
        opening[1:] = ended[b[1:]] > ended[e[:-1]]
        padded = np.concatenate([data, np.zeros(4, dtype=np.uint8)])
        second = _is(padded[b + 1], 0x80, 0x9E)
        latin_cap = (data[b] == 0xC3) & second
        then = b + 1 + latin_cap  # the second letter; a name goes on in lower case
        small = _is(padded[then], 0x61, 0x7A) | ((padded[then] == 0xC3) & (padded[then + 1] >= 0x9F))
        ascii_cap = _is(data[b], 0x41, 0x5A)
        name = (ascii_cap | latin_cap) & small & ~opening
        unit = np.zeros(n, dtype=bool)
        behind = np.flatnonzero(number[:-1]) + 1 if n else np.zeros(0, dtype=int)
        unit[behind] = np.isin(h[behind], _unit_hashes())
        unit[self.first[:-1][self.first[:-1] < n]] = False
        self.slot = number | name | unit
        self.word = h
        self.hash = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, h)))
        self.owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        self._slots = np.concatenate([[0], np.cumsum(self.slot)])
        self._prefix: dict[bool, np.ndarray] = {}

    def windows(self, width: int, literal: bool, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, hash) of every usable window: of the words themselves, or of
        template words with ``least`` literal ones."""
        n = len(self.hash)
        if n < width:
            return np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0, dtype=np.uint64)
        if literal not in self._prefix:
            prefix = np.zeros(n + 1, dtype=np.uint64)
            with np.errstate(over="ignore"):
                np.cumsum(common.mixed(self.word if literal else self.hash) * common.powers(n), out=prefix[1:])
            self._prefix[literal] = prefix
        usable = self.owner[:n - width + 1] == self.owner[width - 1:]
        if not literal:
            usable &= width - (self._slots[width:] - self._slots[:-width]) >= least
        at = np.flatnonzero(usable)
        h = common.span_hashes(self._prefix[literal], at, at + width)
        return self.owner[at], at, common.mixed(h ^ np.uint64(2 * width + literal))

    def slots_of(self, data: bytes, at: int, width: int) -> list[str]:
        return [data[self.begin[w]:self.end[w]].decode("utf-8", "replace").lower()
                for w in range(at, at + width) if self.slot[w]]


_units: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _units:
        line = (" ".join(UNITS)).encode()
        lowered = _WORD[np.frombuffer(line, dtype=np.uint8)]
        _units.append(common.mixed(common.span_hashes(common.prefix_hashes(lowered), *common.word_spans(lowered))))
    return _units[0]


def _narrow(n_words: np.ndarray, width: int) -> np.ndarray:
    """The width of an item's narrower windows; ``width`` if it has none."""
    thirds = np.maximum((n_words - 2) // 3, width // 2)
    return np.where(n_words < width, n_words, np.where(n_words < 3 * width, thirds, width))


def template_windows(texts: DataFrame, key: str, width: int, kinds: list[tuple[int, bool]] | None = None,
                     bitmap: np.ndarray | None = None) -> DataFrame:
    """``key, n_words, n_typed, place, width, literal, window, slots`` of the windows of items, or of
    the windows of documents in the ``kinds`` (width, literal) given that the bitmap lets pass.

    ``place`` counts words from 0; ``slots`` are the words behind the window's placeholders;
    ``n_typed`` is the number of words in template windows of the item.
    """
    kept = texts.select(key, "text")
    shared = None if bitmap is None else texts.sparkSession.sparkContext.broadcast(bitmap)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_texts = common.texts_of(batch.column(1))
            for first, _, data, starts in common.chunks(all_texts):
                words = Templates(data, starts)
                n_words = np.diff(words.first)
                found = []
                for size, literal in [(w, k) for w in range(1, width + 1) for k in (False, True)] if kinds is None else kinds:
                    owner, at, h = words.windows(size, literal, width // 2)
                    if shared is None:
                        own = (size == _narrow(n_words, width)) | (size == width)
                        own &= literal | (n_words >= width)
                        passed = np.flatnonzero(own[owner])
                    else:
                        bucket = (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                        passed = np.flatnonzero(shared.value[bucket >> 3] >> (bucket & 7).astype(np.uint8) & 1)
                    found.append((size, literal, owner[passed], at[passed], h[passed]))
                step = np.zeros(len(words.hash) + 1, dtype=np.int64)
                for size, literal, _, at, _ in found:
                    if not literal:
                        np.add.at(step, at, 1)
                        np.add.at(step, at + size, -1)
                typed = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
                n_typed = np.diff(typed[words.first])
                raw = data.tobytes() if any(len(f[2]) for f in found) else b""
                for size, literal, owner, at, h in found:
                    if len(at):
                        slots = [[] if literal and shared is not None else words.slots_of(raw, a, size) for a in at]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(owner + first)), pa.array(n_words[owner]), pa.array(n_typed[owner]),
                             pa.array(at - words.first[owner]), pa.array(np.full(len(at), size)),
                             pa.array(np.full(len(at), literal)), pa.array(h.view(np.int64)), pa.array(slots, pa.list_(pa.string()))],
                            names=[key, "n_words", "n_typed", "place", "width", "literal", "window", "slots"])

    kind = kept.schema[key].dataType.simpleString()
    return kept.mapInArrow(scan, f"{key} {kind}, n_words long, n_typed long, place long, width long, literal boolean, "
                                 "window long, slots array<string>")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """One bit for each value of the leading bits of the hashes: at most 2**22 of them."""
    leading = F.shiftrightunsigned("window", 64 - BITMAP_BITS).cast("int")
    buckets = np.array([r[0] for r in windows.select(leading).distinct().toLocalIterator()], dtype=np.int64)
    bits = np.zeros(1 << BITMAP_BITS, dtype=bool)
    bits[buckets] = True
    return np.packbits(bits, bitorder="little")


def _covered(spans):
    """The number of places in a set of (at, width)."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(done, x):
        end = x["at"] + x["width"]
        return F.struct(F.greatest(done["end"], end).alias("end"),
                        (done["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(done["end"], x["at"]))).alias("n"))

    return F.aggregate(F.array_sort(spans), start, add, lambda done: done["n"])


def waiting_windows(items: DataFrame, coverage: float, common: int) -> DataFrame:
    """``items`` with ``waits``: whether a window is one of more than ``common`` items, and of an item
    that its windows of this kind cover less than ``coverage`` of, in words and in typed words."""
    shared = (items.select("window", "item_id").distinct().groupBy("window").count()
              .where(F.col("count") > common).select("window", F.lit(True).alias("common")))
    items = written(items.join(shared, "window", "left").withColumn("common", F.coalesce("common", F.lit(False))), "marked")
    span = F.struct(F.col("place").alias("at"), "width")
    covered = (items.where("common").groupBy("item_id")
               .agg(F.max("n_words").alias("of"), F.max("n_typed").alias("of_typed"), F.collect_set(span).alias("spans"),
                    F.collect_set(F.when(~F.col("literal"), span)).alias("typed"))
               .select("item_id", ((_covered("spans") < coverage * F.col("of"))
                                   & ((F.col("of_typed") == 0) | (_covered("typed") < coverage * F.col("of_typed")))).alias("short")))
    return items.join(covered, "item_id", "left").withColumn("waits", F.col("common") & F.col("short")).drop("common", "short")


def matches(found: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Rows of ``found`` with the rows of ``items`` of their window; those that wait only where the
    document has another window of the item."""
    direct = written(found.join(items.where("NOT waits"), "window").drop("waits"), "matches")
    waiting = items.where("waits").drop("waits")
    near = direct.join(waiting.select("item_id").distinct(), "item_id", "left_semi").select(key, "item_id").distinct()
    late = near.join(waiting, "item_id").join(found, [key, "window"])
    return direct.unionByName(late)


def leaks(docs: DataFrame, benchmark: DataFrame, key: str, width: int = WINDOW, coverage: float = COVERAGE,
          common: int = COMMON) -> DataFrame:
    """``key, item_id, coverage``: the items each document holds. ``key`` names a document."""
    items = written(template_windows(benchmark.where("item_id IS NOT NULL"), "item_id", width), "items")
    kinds = sorted((r["width"], r["literal"]) for r in items.select("width", "literal").distinct().collect())
    found = template_windows(docs, key, width, kinds, _bitmap(items)).select(key, "place", "window", "slots")
    found = written(found, "document-windows")
    item = written(waiting_windows(items, coverage, common), "items").select(
        "item_id", "n_words", "n_typed", F.col("place").alias("at"), "width", "literal", "window", F.col("slots").alias("asked"), "waits")
    pairs = matches(found, item, key).withColumn("given", F.when(F.col("literal"), F.col("asked")).otherwise(F.col("slots")))
    pairs = pairs.where(F.size("given") == F.size("asked")).withColumn("shift", F.col("place") - F.col("at"))
    # The windows of one shift, and of ranges of shifts that overlap by half.
    reach = F.greatest(F.col("n_words"), F.lit(width))
    groups = [(0, F.col("shift")), (1, F.floor(F.col("shift") / reach)), (2, F.floor((F.col("shift") + reach / 2) / reach))]
    pairs = pairs.select(key, "item_id", "n_words", "n_typed", F.struct("at", "width").alias("span"), "literal",
                         F.arrays_zip("asked", "given").alias("slots"),
                         F.explode(F.array(*[F.struct(F.lit(k).alias("k"), v.cast("long").alias("v")) for k, v in groups])).alias("range"))
    by = [key, "item_id", "range"]
    covered = (pairs.groupBy(*by).agg(F.max("n_words").alias("n_words"), F.max("n_typed").alias("n_typed"),
                                      F.collect_set("span").alias("spans"),
                                      F.collect_set(F.when(~F.col("literal"), F.col("span"))).alias("typed"))
               .withColumn("n", _covered("spans")).withColumn("n_of_typed", _covered("typed")))
    least = F.least(F.lit(width).cast("long"), F.col("n_words"))
    share = lambda n, of: F.when((F.col(n) >= least) & (F.col(of) > 0), F.col(n) / F.col(of)).otherwise(0.0)
    covered = covered.select(*by, F.greatest(share("n", "n_words"), share("n_of_typed", "n_typed")).alias("coverage"))
    slots = (pairs.where(F.size("slots") > 0).select(*by, F.explode("slots").alias("s"))
             .select(*by, F.col("s.asked").alias("asked"), F.col("s.given").alias("given")).distinct()
             .groupBy(*by, "asked").count().where("count > 1").select(*by).distinct())
    return (covered.where(F.col("coverage") >= coverage).join(slots, by, "left_anti")
            .groupBy(key, "item_id").agg(F.max("coverage").alias("coverage")))


def row_key():
    """Names a document by id and text, so that rows that differ in either are told apart."""
    return F.xxhash64("doc_id", "text")


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """``_row, n_items, items, coverage`` of the documents that hold a benchmark item."""
    found = leaks(docs.select(row_key().alias("_row"), "text"), benchmark, "_row", width, coverage)
    return found.groupBy("_row").agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items"),
                                     F.max("coverage").alias("coverage"))
