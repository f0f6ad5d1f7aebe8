"""Toxicity: a convolutional text classifier on hashed word embeddings.

A word is the sum of hashed embeddings of the word and of its first 3 to 6 bytes, so that
unseen inflections of a known stem still carry its meaning. Filters of several widths slide
over the words, each keeps its maximum over the whole text, and a linear layer scores the
maxima. Embeddings start from the log odds of their features and are then trained with the
filters by gradient descent. The threshold is calibrated for each language; the language is
read from function words of the text, never from a column.

Every labelled document that learning may see takes part, in tasks; the driver holds the model
and sums of its size. A fifth, chosen by hash, only calibrates the thresholds.

1. The texts with their labels are written in shards, by hash of the id.
2. Documents with each feature are counted by class: the log odds.
3. In each epoch every shard goes on from the same model by gradient steps; a feature moves by
   the mean of the changes in the shards that changed it, weighed by their texts.
4. The margins of all labelled documents are counted in cells of 1/256 by language and class,
   from which the thresholds are read.

Sums are of integers, so reruns agree. A shard of very many bytes that Spark reads in parts
counts as several.

Defined results: null and empty texts have no words and get the score of an empty text;
repeated rows are scored alike; a repeated labelled id counts once, with the highest of its
labels and the least of its texts; an empty table gives an empty result; without any usable
label every score is 0. Other columns are neither read nor returned by :func:`score_documents`.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from paceline.llm import common
from paceline.sources.scratch import written

#: Words that mark a language.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "is", "that", "with", "for", "this", "was"),
    "de": ("der", "die", "und", "das", "von", "mit", "ist", "nicht", "sich", "dem"),
    "fr": ("le", "les", "des", "et", "dans", "pour", "est", "du", "une", "qui"),
    "es": ("el", "los", "las", "y", "por", "para", "una", "del", "con", "se"),
}
LANGUAGES = (*FUNCTION_WORDS, "other")

PREFIXES = (3, 4, 5, 6)
WORD_BYTES = common.byte_table(word=[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])

STEP_TEXTS = 32  # texts of one gradient step
_CELLS, _CELL = 1 << 14, 1 / 256  # margins from -32 to 32 as they are counted
_UNIT = 1 << 20  # changes are summed as integers of this part


@dataclass(frozen=True)
class ToxicityParams:
    """``shard_rows`` labelled documents, more or less, make the steps between two means.

    All labelled documents are learned from, unless ``sample_per_class`` bounds those of each class.
    """

    buckets: int = 1 << 18
    dim: int = 8
    filters: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    sample_per_class: int | None = None
    shard_rows: int = 4096
    epochs: int = 4
    rate: float = 0.02
    seed: int = 7


@dataclass
class ToxicityModel:
    params: ToxicityParams
    embedding: np.ndarray
    kernels: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    intercept: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))


def features(data: np.ndarray, starts: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of all words of a chunk (words x 5, 0 for none) and each text's first word."""
    begin, end = common.word_spans(WORD_BYTES[data])
    prefix = common.prefix_hashes(WORD_BYTES[data])
    out = np.zeros((len(begin), 1 + len(PREFIXES)), dtype=np.int32)
    out[:, 0] = _bucket(common.span_hashes(prefix, begin, end), 0, buckets)
    for k, n in enumerate(PREFIXES, 1):
        long = np.flatnonzero(end - begin > n)
        out[long, k] = _bucket(common.span_hashes(prefix, begin[long], begin[long] + n), k, buckets)
    return out, np.searchsorted(begin, starts)


def _bucket(h: np.ndarray, salt: int, buckets: int) -> np.ndarray:
    return (common.mixed(h + np.uint64(salt)) % np.uint64(buckets - 1)).astype(np.int32) + 1


def _language_table(buckets: int) -> np.ndarray:
    table = np.full(buckets, len(LANGUAGES) - 1, dtype=np.int8)
    for code, words in enumerate(FUNCTION_WORDS.values()):
        for _, _, data, starts in common.chunks([" ".join(words).encode()]):
            table[features(data, starts, buckets)[0][:, 0]] = code
    return table


def languages(ids: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The language with most function words in each text; ``other`` without any."""
    known = len(LANGUAGES) - 1
    code = table[ids[:, 0]]
    counts = np.zeros((len(first) - 1, known), dtype=np.int64)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    seen = code < known
    np.add.at(counts, (owner[seen], code[seen]), 1)
    return np.where(counts.any(axis=1), counts.argmax(axis=1), known)


def _padded(ids: np.ndarray, first: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pad`` zero rows after each text; texts without words keep one zero row."""
    n = np.maximum(np.diff(first), 1)
    start = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n + pad, out=start[1:])
    out = np.zeros((start[-1], ids.shape[1]), dtype=np.int32)
    words = np.diff(first)
    at = np.repeat(start[:-1] - first[:-1], words) + np.arange(len(ids))
    out[at] = ids
    return out, start[:-1], start[:-1] + n


def _convolved(model: ToxicityModel, x: np.ndarray) -> list[np.ndarray]:
    out = []
    for kernel in model.kernels:
        z = x @ kernel[0]
        for j in range(1, len(kernel)):
            z[:-j] += x[j:] @ kernel[j]
        out.append(z)
    return out


def _embedded(model: ToxicityModel, ids: np.ndarray) -> np.ndarray:
    x = model.embedding[ids[:, 0]]
    for k in range(1, ids.shape[1]):
        x += model.embedding[ids[:, k]]
    return x


def logits(model: ToxicityModel, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    padded, begin, end = _padded(ids, first, max(model.params.widths) - 1 or 1)
    x = _embedded(model, padded)
    edges = np.stack([begin, end], axis=1).ravel()  # each end lies before the next begin
    pooled = np.concatenate([np.maximum.reduceat(z, edges, axis=0)[::2] for z in _convolved(model, x)], axis=1)
    return np.maximum(pooled + model.bias, 0) @ model.weights + model.intercept


def _batches(texts: list[bytes], toxic: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(feature ids, each text's first word, labels) of a few texts at a time."""
    for k in range(0, len(texts), STEP_TEXTS):
        ids, first = [], [np.zeros(1, dtype=np.int64)]
        for _, _, data, starts in common.chunks(texts[k:k + STEP_TEXTS]):
            got, at = features(data, starts, buckets)
            ids.append(got)
            first.append(at[1:] + first[-1][-1])
        yield np.concatenate(ids), np.concatenate(first), toxic[k:k + STEP_TEXTS]


def train(texts: list[bytes], toxic: np.ndarray, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Fits on texts at hand as :func:`fit` does on tables, all of them one shard."""
    calibrating = np.random.default_rng(params.seed).random(len(texts)) < 0.2
    fitting = [t for t, c in zip(texts, calibrating) if not c]
    seen = np.zeros((2, params.buckets), dtype=np.int64)
    _count(seen, fitting, toxic[~calibrating])
    model = _started(seen, params)
    if not seen[:, 0].all():
        return model
    for epoch in range(params.epochs):
        _descend(model, fitting, toxic[~calibrating], epoch)
    cells = _no_cells()
    _count_margins(cells, model, texts, toxic, calibrating, _language_table(params.buckets))
    _calibrate(model, cells)
    return model


def _count(seen: np.ndarray, texts: list[bytes], toxic: np.ndarray) -> None:
    """Adds, by class and feature, the texts that hold it; feature 0 counts the texts."""
    for ids, first, label in _batches(texts, toxic, seen.shape[1]):
        owner = np.repeat(np.arange(len(label)), np.diff(first))
        held = np.unique((owner[:, None] << 32) | ids)
        feature = held & 0xFFFFFFFF
        some = feature > 0
        np.add.at(seen, (label[held[some] >> 32], feature[some]), 1)
        np.add.at(seen[:, 0], label, 1)


def _started(seen: np.ndarray, params: ToxicityParams) -> ToxicityModel:
    """The model before its first step; without texts of both classes it takes nothing for toxic."""
    rng = np.random.default_rng(params.seed)
    dim, count = params.dim, params.filters
    embedding = rng.normal(0, 0.05, (params.buckets, dim)).astype(np.float32)
    embedding[:, 0] = _log_odds(seen)
    embedding[0] = 0
    kernels = [rng.normal(0, 0.1, (w, dim, count)).astype(np.float32) for w in params.widths]
    for kernel in kernels:
        kernel[0, 0] = np.abs(kernel[0, 0]) + 0.5
    total = count * len(kernels)
    model = ToxicityModel(params, embedding, kernels, np.full(total, -0.5, dtype=np.float32),
                          np.full(total, 1.0 / total, dtype=np.float32), -1.0)
    if not seen[:, 0].all():
        model.thresholds[:] = np.inf
    return model


def _log_odds(seen: np.ndarray) -> np.ndarray:
    """Shrunk log odds of each feature's presence in toxic against clean texts."""
    size, both = seen[:, 0], seen.sum(axis=0)
    odds = np.log((seen[1] + 0.5) / (size[1] + 1)) - np.log((seen[0] + 0.5) / (size[0] + 1))
    return (odds * both / (both + 4)).clip(-3, 6).astype(np.float32)


def _descend(model: ToxicityModel, texts: list[bytes], toxic: np.ndarray, epoch: int) -> None:
    for ids, first, label in _batches(texts, toxic, model.params.buckets):
        _step(model, ids, first, label, model.params.rate / (1 + epoch))


def _step(model: ToxicityModel, ids: np.ndarray, first: np.ndarray, toxic: np.ndarray, rate: float) -> None:
    """One gradient step on a few texts, through the words that won the pooling."""
    padded, begin, end = _padded(ids, first, max(model.params.widths) - 1 or 1)
    x = _embedded(model, padded)
    convolved = _convolved(model, x)
    winners = [np.stack([b + z[b:e].argmax(axis=0) for b, e in zip(begin, end)]) for z in convolved]
    pooled = np.concatenate([np.take_along_axis(z, w, axis=0) for z, w in zip(convolved, winners)], axis=1)
    hidden = np.maximum(pooled + model.bias, 0)
    score = hidden @ model.weights + model.intercept
    error = ((1 / (1 + np.exp(-score.clip(-30, 30)))) - toxic).astype(np.float32) / len(toxic)
    back = np.outer(error, model.weights) * (hidden > 0)
    model.weights -= rate * 10 * (hidden.T @ error)
    model.intercept -= rate * 10 * float(error.sum())
    model.bias -= rate * back.sum(axis=0)
    f = model.params.filters
    for k, (kernel, won) in enumerate(zip(model.kernels, winners)):
        g = back[:, k * f:(k + 1) * f]
        for j in range(len(kernel)):
            at = won + j
            change = np.einsum("bf,bfd->df", g, x[at])
            pull = np.einsum("bf,df->bfd", g, kernel[j]).reshape(-1, x.shape[1])
            rows = padded[at.ravel()]
            kernel[j] -= rate * change
            for c in range(rows.shape[1]):
                np.add.at(model.embedding, rows[:, c], -rate * 10 * pull)
    model.embedding[0] = 0


def _packed(model: ToxicityModel) -> np.ndarray:
    """All that steps change, ``dim`` numbers a row: the embeddings first."""
    rest = np.concatenate([*[k.ravel() for k in model.kernels], model.bias, model.weights, [model.intercept]])
    rows = np.zeros((-(-len(rest) // model.params.dim), model.params.dim))
    rows.ravel()[:len(rest)] = rest
    return np.concatenate([model.embedding, rows])


def _unpack(model: ToxicityModel, rows: np.ndarray) -> None:
    model.embedding = rows[:model.params.buckets].astype(np.float32)
    rest = rows[model.params.buckets:].ravel()
    parts = [*model.kernels, model.bias, model.weights]
    ends = np.cumsum([p.size for p in parts])
    for part, end in zip(parts, ends):
        part[:] = rest[end - part.size:end].reshape(part.shape)
    model.intercept = float(rest[ends[-1]])


def _no_cells() -> np.ndarray:
    return np.zeros((len(LANGUAGES), 2, 2, _CELLS), dtype=np.int64)


def _count_margins(cells, model, texts, toxic, calibrating, table) -> None:
    """Counts texts by language, whether they calibrate, class and cell of their margin."""
    for k, (ids, first, label) in enumerate(_batches(texts, toxic, model.params.buckets)):
        at = np.rint(logits(model, ids, first) / _CELL).astype(np.int64) + _CELLS // 2
        held = calibrating[k * STEP_TEXTS:(k + 1) * STEP_TEXTS].astype(np.int64)
        np.add.at(cells, (languages(ids, first, table), held, label, at.clip(0, _CELLS - 1)), 1)


def _calibrate(model: ToxicityModel, cells: np.ndarray) -> None:
    """The threshold of best balanced accuracy of each language, the middle of a tie.

    A language with fewer than 10 calibrating texts of either class falls back to all its
    labelled texts, and to all languages together if it has fewer than 5 of a class.
    """
    def best(counts):
        used = np.flatnonzero(counts.any(axis=0))
        s, y = (used - _CELLS // 2) * _CELL, counts[:, used]
        cuts = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
        clean = np.concatenate([[0], np.cumsum(y[0])]) / max(1, y[0].sum())
        caught = 1 - np.concatenate([[0], np.cumsum(y[1])]) / max(1, y[1].sum())
        value = 3 * clean + caught  # a clean document lost weighs more: most documents are clean
        top = np.flatnonzero(value >= value.max() - 1e-9)
        return float((cuts[top[0]] + cuts[top[-1]]) / 2)

    everything = best(cells.sum(axis=(0, 1)))
    for code in range(len(LANGUAGES)):
        own, held = cells[code].sum(axis=0), cells[code, 1]
        enough = lambda counts, n: counts.sum(axis=1).min() >= n
        model.thresholds[code] = best(held) if enough(held, 10) else best(own) if enough(own, 5) else everything


def score_texts(model: ToxicityModel, texts: list[bytes], table: np.ndarray) -> np.ndarray:
    out = np.zeros(len(texts))
    for begin, end, data, starts in common.chunks(texts):
        ids, first = features(data, starts, model.params.buckets)
        margin = logits(model, ids, first) - model.thresholds[languages(ids, first, table)]
        out[begin:end] = 1 / (1 + np.exp(-margin.clip(-500, 500)))
    return out


def training_sample(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """``shard, place, doc_id, label_toxic, calibrating, text``: all documents that learning may see.

    Of each class at most ``sample_per_class`` by hash order, where that is given.
    """
    seen = F.col("doc_id").isNotNull() & ~common.held_out()
    place = F.xxhash64(F.lit(params.seed), "doc_id")
    rows = (labels.where(seen & F.col("toxic").isin(0, 1))
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label_toxic")))
    if params.sample_per_class is not None:
        picked = [rows.where(F.col("label_toxic") == y).orderBy(place).limit(params.sample_per_class) for y in (0, 1)]
        rows = picked[0].union(picked[1])
    rows = written(rows, "toxicity-labels")
    shards = max(1, -(-rows.count() // params.shard_rows))
    # Texts and labels meet in one shuffle by shard: a join by id would move the texts twice.
    texts = docs.where(seen).select("doc_id", F.lit(None).cast("int").alias("label_toxic"),
                                    F.coalesce("text", F.lit("")).alias("text"))
    both = texts.union(rows.select("doc_id", "label_toxic", F.lit(None).cast("string").alias("text")))
    return (both.withColumn("place", place).withColumn("shard", F.pmod("place", F.lit(shards)).cast("int"))
            .repartition(shards, "shard").groupBy("shard", "place", "doc_id")
            .agg(F.max("label_toxic").alias("label_toxic"), F.min("text").alias("text"))
            .where(F.col("label_toxic").isNotNull() & F.col("text").isNotNull())
            .withColumn("calibrating", F.pmod(F.xxhash64(F.lit(params.seed + 1), "doc_id"), F.lit(5)) == 0)
            .select("shard", "place", "doc_id", "label_toxic", "calibrating", "text"))


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Trains in tasks on all texts; the driver gets sums by feature, as many as the model has rows."""
    sample = training_sample(docs, labels, params).sortWithinPartitions("shard", "place", "doc_id")
    rows = written(sample.select("shard", "label_toxic", "calibrating", "text"), "toxicity-texts")
    fitting = rows.where(~F.col("calibrating"))
    seen = _counted(fitting, params)
    model = _started(seen, params)
    if not seen[:, 0].all():
        return model
    for epoch in range(params.epochs):
        _move(model, fitting, epoch)
    _calibrate(model, _counted_margins(rows, model))
    return model


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    shard, toxic, calibrating = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
    return shard, toxic, calibrating, common.texts_of(batch.column(3))


def _counted(rows: DataFrame, params: ToxicityParams) -> np.ndarray:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, params.buckets), dtype=np.int64)
        for batch in batches:
            _, toxic, _, texts = _read(batch)
            _count(seen, texts, toxic)
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[0, at]), pa.array(seen[1, at])],
                                         names=["feature", "clean", "toxic"])

    got = (rows.mapInArrow(counted, "feature long, clean long, toxic long").groupBy("feature")
           .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow())
    seen = np.zeros((2, params.buckets), dtype=np.int64)
    seen[:, got.column("feature").to_numpy()] = [got.column("clean").to_numpy(), got.column("toxic").to_numpy()]
    return seen


def _move(model: ToxicityModel, rows: DataFrame, epoch: int) -> None:
    """One epoch: the shards' steps from this model, and the mean of their changes."""
    spark, names = rows.sparkSession, [f"d{k}" for k in range(model.params.dim)]
    shared = spark.sparkContext.broadcast(model)  # buckets x dim floats, whatever the input

    def change(own: ToxicityModel, texts: int) -> pa.RecordBatch:
        by = _packed(own) - _packed(shared.value)
        at = np.flatnonzero(by.any(axis=1))
        by = np.rint(by[at] * (texts * _UNIT)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), texts)), *[pa.array(c) for c in by.T]],
                                          names=["row", "texts", *names])

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, current, done = None, None, 0
        for batch in batches:
            shard, toxic, _, texts = _read(batch)
            edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else []
            for a, b in zip(edges[:-1], edges[1:]):
                if own is None or shard[a] != current:
                    if own is not None:
                        yield change(own, done)
                    own, current, done = copy.deepcopy(shared.value), shard[a], 0
                _descend(own, texts[a:b], toxic[a:b], epoch)
                done += int(b - a)
        if own is not None:
            yield change(own, done)

    mean = [(F.sum(c) / F.sum("texts") / _UNIT).alias(c) for c in names]
    got = (rows.mapInArrow(moved, ", ".join(f"{c} long" for c in ("row", "texts", *names)))
           .groupBy("row").agg(*mean).select("row", *[F.col(c).cast("float") for c in names]).toArrow())
    packed = _packed(model)
    packed[got.column("row").to_numpy()] += np.stack([got.column(c).to_numpy() for c in names], axis=1)
    _unpack(model, packed)
    shared.destroy()


def _counted_margins(rows: DataFrame, model: ToxicityModel) -> np.ndarray:
    shared = rows.sparkSession.sparkContext.broadcast(model)
    table = _language_table(model.params.buckets)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _no_cells()
        for batch in batches:
            _, toxic, calibrating, texts = _read(batch)
            _count_margins(cells, shared.value, texts, toxic, calibrating, table)
        at = np.flatnonzero(cells.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells.ravel()[at])], names=["cell", "times"])

    got = rows.mapInArrow(counted, "cell long, times long").groupBy("cell").agg(F.sum("times").alias("times")).toArrow()
    cells = _no_cells()
    cells.ravel()[got.column("cell").to_numpy()] = got.column("times").to_numpy()
    shared.destroy()
    return cells


def score_documents(docs: DataFrame, model: ToxicityModel, keep: list[Column | str], score: str = "score") -> DataFrame:
    """``keep`` columns and the score (0 to 1; 0.5 is the threshold of the text's language).

    A kept column named like the score column is replaced by it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x dim floats, whatever the input
    table = _language_table(model.params.buckets)
    kept = docs.select(*keep).columns
    kept = [c for c in kept if c != score]
    rows = docs.select(*[k for k in keep if k != score], *([] if "text" in kept else ["text"]))
    at = rows.columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(shared.value, common.texts_of(batch.column(at)), table)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(scores, pa.float64())],
                                             names=[*kept, score])

    schema = rows.select(*kept).withColumn(score, F.lit(0.0)).schema
    return rows.mapInArrow(scored, schema)
