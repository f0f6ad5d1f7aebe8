"""Quality classifier: histogram gradient-boosted trees over document statistics.

Tasks turn each whole text into some forty statistics (lengths, byte classes, word shapes,
repetition of words, word triples and lines, function words). The statistics of a bounded
sample of labelled documents are fitted on the driver: features are cut at quantiles into
histogram bins, trees of one depth grow level by level on sums of gradients per bin. The
fitted trees are flattened into arrays of complete trees, so that a batch of documents walks
all trees at once in numpy.

Classes are sampled separately and weighed by their numbers of labelled documents, so a score
estimates the share of quality 1 among labelled documents that look alike.

Defined results: null and empty texts have the statistics of an empty text; very long texts are
read whole; repeated rows are scored alike; a repeated labelled id counts once, with the highest
of its labels and the least of its statistics; an empty table gives an empty result; without any
usable label every score is 0.5. Other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paceline.llm import common
from paceline.llm.toxicity import FUNCTION_WORDS

#: Byte classes: ASCII by kind, then continuation and lead bytes of longer characters.
BYTE_CLASSES = {
    "blank": [0x20, 0x09, 0x0B, 0x0C, 0x0D],
    "line_end": [0x0A],
    "lower": [*range(0x61, 0x7B)],
    "upper": [*range(0x41, 0x5B)],
    "digit": [*range(0x30, 0x3A)],
    "stop": [*b".!?"],
    "pause": [*b",;:"],
    "quote": [*b"'\"()-"],
    "symbol": [*b"#$%&*+/<=>@[\\]^_`{|}~"],
    "continued": [*range(0x80, 0xC0)],
    "lead": [*range(0xC0, 0x100)],
}
_CLASS_NAMES = [*BYTE_CLASSES, "control"]
_CLASS = np.full(256, len(BYTE_CLASSES), dtype=np.int64)
for _k, _bytes in enumerate(BYTE_CLASSES.values()):
    _CLASS[_bytes] = _k

_WORDS = common.byte_table(breaks=common.SPACES)
_LINES = common.byte_table(breaks=[0x0A])
_UPPER, _LOWER, _DIGIT, _STOP, _PAUSE, _SYMBOL = (
    _CLASS_NAMES.index(c) for c in ("upper", "lower", "digit", "stop", "pause", "symbol"))
_LETTERS = np.isin(_CLASS, [_UPPER, _LOWER, _DIGIT, *(_CLASS_NAMES.index(c) for c in ("continued", "lead"))])
# Two counts travel in one running sum, 32 bits each.
_CASES = (_CLASS == _UPPER).astype(np.int64) + ((_CLASS == _LOWER).astype(np.int64) << 32)
_MARKS = (_CLASS == _DIGIT).astype(np.int64) + (_LETTERS.astype(np.int64) << 32)

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "word_bytes_spread",
    *[f"share_{c}" for c in _CLASS_NAMES], "upper_of_letters",
    "ends_in_stop", "ends_in_pause", "ends_in_symbol", "no_letter", "all_capitals", "with_digit", "mixed_case",
    "repeats_last", "repeats_last_but_one", "function_words",
    "distinct_words", "word_entropy", "top_word", "words_once",
    "distinct_triples", "top_triple", "distinct_lines", "words_a_line", "words_a_stop", "longest_word",
]


@dataclass(frozen=True)
class QualityParams:
    """``sample_per_class`` bounds the labelled documents of each class used for training."""

    sample_per_class: int = 10_000
    trees: int = 60
    depth: int = 4
    bins: int = 48
    rate: float = 0.15
    least_weight: float = 4.0
    shrink: float = 2.0
    seed: int = 11


@dataclass
class TreeModel:
    """Complete trees of one depth: node i of a tree has children 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # trees x inner nodes; greater values go right
    leaf: np.ndarray  # trees x leaves


def _word_hashes() -> np.ndarray:
    text = np.frombuffer(" ".join(w for words in FUNCTION_WORDS.values() for w in words).encode() + b" ", dtype=np.uint8)
    begin, end = common.word_spans(_WORDS[text])
    return np.unique(common.span_hashes(common.prefix_hashes(_WORDS[text]), begin, end))


def _repetition(owner: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Per text: different items, entropy in nats, count of the commonest, items seen once."""
    shift = np.uint64(64 - max(1, n - 1).bit_length())
    key = np.sort((owner.astype(np.uint64) << shift) | (common.mixed(h) >> (np.uint64(64) - shift)))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    times = np.diff(np.concatenate([new, [len(key)]]))
    of = (key[new] >> shift).astype(np.int64)
    different = np.bincount(of, minlength=n)
    total = np.maximum(np.bincount(of, weights=times, minlength=n), 1)
    p = times / total[of]
    entropy = np.bincount(of, weights=-p * np.log(p), minlength=n) if len(of) else np.zeros(n)
    most = np.zeros(n)
    if len(of):
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        most[of[first]] = np.maximum.reduceat(times, first)
    return different, entropy, most, np.bincount(of[times == 1], minlength=n)


def statistics(data: np.ndarray, starts: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The features of all texts of a chunk (texts x features)."""
    n = len(starts) - 1
    classes = len(_CLASS_NAMES)
    size = np.diff(starts) - 1
    kind = _CLASS[data]
    owner = np.repeat(np.arange(n), np.diff(starts))
    counts = np.bincount(owner * classes + kind, minlength=n * classes).reshape(n, classes).astype(np.float64)
    lines = counts[:, 1].copy()
    counts[:, 1] -= 1  # the line feed that joins texts

    lowered = _WORDS[data]
    begin, end = common.word_spans(lowered)
    at = np.searchsorted(begin, starts)
    words = np.diff(at)
    per_word = np.maximum(words, 1)
    of = np.repeat(np.arange(n), words)
    h = common.span_hashes(common.prefix_hashes(lowered), begin, end)
    length = (end - begin).astype(np.float64)

    def share(flags) -> np.ndarray:
        return np.bincount(of, weights=flags, minlength=n) / per_word

    def inside(pairs) -> tuple[np.ndarray, np.ndarray]:
        total = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(pairs[data], out=total[1:])
        got = total[end] - total[begin]
        return got & 0xFFFFFFFF, got >> 32

    mean = share(length)
    spread = np.sqrt(np.maximum(share(length * length) - mean * mean, 0))
    longest = np.zeros(n)
    some = np.flatnonzero(words)
    if len(some):
        longest[some] = np.maximum.reduceat(length, at[some])
    last = kind[end - 1] if len(end) else np.zeros(0, dtype=np.int64)
    (upper, lower), (digits, letters) = inside(_CASES), inside(_MARKS)
    back = [np.concatenate([np.zeros(k, dtype=bool), (h[k:] == h[:-k]) & (of[k:] == of[:-k])])[:len(h)] for k in (1, 2)]
    place = np.searchsorted(known, h)
    function = known[np.minimum(place, len(known) - 1)] == h

    different, entropy, most, once = _repetition(of, h, n)
    whole = np.flatnonzero(of[2:] == of[:-2]) if len(h) > 2 else np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        triple = common.mixed(common.mixed(h[whole]) * np.uint64(3) + h[whole + 1]) * np.uint64(5) + h[whole + 2] if len(whole) else h[:0]
    triples = np.maximum(np.bincount(of[whole], minlength=n), 1)
    triple_kinds, _, triple_most, _ = _repetition(of[whole], triple, n)
    line_bytes = _LINES[data]
    line_from, line_to = common.word_spans(line_bytes)
    line_of = np.searchsorted(starts, line_from, side="right") - 1
    full_lines = np.maximum(np.bincount(line_of, minlength=n), 1)
    line_kinds = _repetition(line_of, common.span_hashes(common.prefix_hashes(line_bytes), line_from, line_to), n)[0]

    per_byte = np.maximum(size, 1)[:, None]
    cased = np.maximum(counts[:, _UPPER] + counts[:, _LOWER], 1)
    columns = [
        np.log1p(size), np.log1p(words), mean, spread,
        *(counts / per_byte).T, counts[:, _UPPER] / cased,
        share(last == _STOP), share(last == _PAUSE), share(last == _SYMBOL), share(letters == 0),
        share((upper > 1) & (lower == 0)), share(digits > 0), share((upper > 1) & (lower > 0)),
        share(back[0]), share(back[1]), share(function),
        different / per_word, entropy / np.log(np.maximum(words, 2)), most / per_word, once / per_word,
        triple_kinds / triples, triple_most / triples, line_kinds / full_lines,
        words / np.maximum(lines, 1), words / np.maximum(counts[:, _STOP], 1), np.log1p(longest),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def text_statistics(texts: list[bytes]) -> np.ndarray:
    known, out = _word_hashes(), np.zeros((len(texts), len(FEATURES)), dtype=np.float32)
    for first, last, data, starts in common.chunks(texts):
        out[first:last] = statistics(data, starts, known)
    return out


def margins(model: TreeModel, x: np.ndarray) -> np.ndarray:
    """Log odds: every row walks all trees, one level at a time."""
    trees, leaves = model.leaf.shape
    out = np.empty(len(x))
    every = np.arange(trees)
    for k in range(0, len(x), 4096):
        rows = x[k:k + 4096]
        node = np.zeros((len(rows), trees), dtype=np.int64)
        for _ in range(leaves.bit_length() - 1):
            value = np.take_along_axis(rows, model.feature[every, node], axis=1)
            node = 2 * node + 1 + (value > model.cut[every, node])
        out[k:k + 4096] = model.base + model.leaf[every, node - (leaves - 1)].sum(axis=1)
    return out


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, params: QualityParams = QualityParams()) -> TreeModel:
    """Boosted trees on the logistic loss, by second-order gains over histograms."""
    inner, leaves = (1 << params.depth) - 1, 1 << params.depth
    model = TreeModel(0.0, np.zeros((params.trees, inner), dtype=np.int64),
                      np.full((params.trees, inner), np.inf, dtype=np.float32), np.zeros((params.trees, leaves)))
    if not len(x):
        return model
    weight = weight / weight.mean()
    positive = float(weight[y == 1].sum())
    model.base = float(np.log((positive + 0.5) / (weight.sum() - positive + 0.5)))
    if len(np.unique(y)) < 2:
        return model
    f, b = x.shape[1], params.bins
    levels = np.linspace(0, 1, b + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, j], levels, method="lower")) for j in range(f)]
    code = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(f)], axis=1)  # value > edge k: code > k
    cell = code + np.arange(f) * b
    margin = np.full(len(x), model.base)
    for t in range(params.trees):
        p = 1 / (1 + np.exp(-margin))
        g, hess = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(x), dtype=np.int64)  # within the level
        for level in range(params.depth):
            nodes = 1 << level
            flat = (cell + (node * f * b)[:, None]).ravel()
            sums = [np.bincount(flat, weights=np.repeat(s, f), minlength=nodes * f * b).reshape(nodes, f, b).cumsum(axis=2)
                    for s in (g, hess)]
            gl, hl = sums[0][:, :, :-1], sums[1][:, :, :-1]
            ga, ha = sums[0][:, :, -1:], sums[1][:, :, -1:]
            gain = gl ** 2 / (hl + params.shrink) + (ga - gl) ** 2 / (ha - hl + params.shrink) - ga ** 2 / (ha + params.shrink)
            gain[(hl < params.least_weight) | (ha - hl < params.least_weight)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            j, k = best // (b - 1), best % (b - 1)
            split = gain[np.arange(nodes), j, k] > 1e-9
            at = nodes - 1 + np.arange(nodes)
            model.feature[t, at] = j
            model.cut[t, at] = [edges[a][min(c, len(edges[a]) - 1)] if ok else np.inf for a, c, ok in zip(j, k, split)]
            right = split[node] & (x[np.arange(len(x)), j[node]] > model.cut[t, at][node])
            node = 2 * node + right
        total = [np.bincount(node, weights=s, minlength=leaves) for s in (g, hess)]
        model.leaf[t] = -params.rate * total[0] / (total[1] + params.shrink)
        margin += model.leaf[t][node]
    return model


def training_sample(docs: DataFrame, labels: DataFrame, params: QualityParams) -> DataFrame:
    """``doc_id, label_quality, stats`` of at most ``sample_per_class`` documents of each class."""
    rows = _labelled(labels)
    order = F.xxhash64(F.lit(params.seed), "doc_id")
    picked = [rows.where(F.col("label_quality") == y).orderBy(order, "doc_id").limit(params.sample_per_class) for y in (0, 1)]
    chosen = F.broadcast(picked[0].union(picked[1]))  # at most 2 x sample_per_class rows of 12 bytes
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    texts = texts.select("doc_id", "label_quality", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_statistics(common.texts_of(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float32()))],
                                             names=["doc_id", "label_quality", "stats"])

    schema = texts.select("doc_id", "label_quality", F.array(F.lit(0.0).cast("float")).alias("stats")).schema
    return texts.mapInArrow(read, schema).groupBy("doc_id", "label_quality").agg(F.min("stats").alias("stats"))


def _labelled(labels: DataFrame) -> DataFrame:
    """The labels learning may see, one row a document."""
    usable = F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~common.held_out()
    return labels.where(usable).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label_quality"))


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> TreeModel:
    """Trains on the driver, which gets statistics of the sample (172 bytes a document), no texts."""
    counts = {r["label_quality"]: r["count"] for r in _labelled(labels).groupBy("label_quality").count().collect()}
    got = training_sample(docs, labels, params).toArrow().sort_by("doc_id")
    y = got.column("label_quality").to_numpy().astype(np.int64)
    x = got.column("stats").combine_chunks().flatten().to_numpy().reshape(len(y), len(FEATURES))
    sampled = np.maximum(np.bincount(y, minlength=2), 1)
    return train(x, y, np.array([counts.get(c, 0) / sampled[c] for c in (0, 1)])[y], params)


def score_documents(docs: DataFrame, model: TreeModel, keep: list[str], score: str = "score") -> DataFrame:
    """``keep`` columns and the estimated chance of quality 1.

    A kept column named like the score column is replaced by it.
    """
    kept = [c for c in keep if c != score]
    rows = docs.select(*kept, *([] if "text" in kept else ["text"]))
    at = rows.columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = margins(model, text_statistics(common.texts_of(batch.column(at))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(1 / (1 + np.exp(-z)), pa.float64())],
                                             names=[*kept, score])

    schema = rows.select(*kept).withColumn(score, F.lit(0.0)).schema
    return rows.mapInArrow(scored, schema)
