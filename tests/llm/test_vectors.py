"""Hard negatives, whitening and the embedding join against brute force, and on awkward vectors."""

import math

import numpy as np
import pytest

from paceline.llm import embedding_join, hard_negatives, whitening

VECTORS = "vec_id long, embedding array<double>, label long, rank int, n long"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, 2) for i, v, y in rows], VECTORS)


def cloud(seed, n, dim, labels, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * np.linspace(2, 0.5, dim)
    x = np.concatenate([x, np.repeat(x[:1], copies, axis=0)])
    return [(int(i), [float(c) for c in v], int(i * 7 % 11 % labels)) for i, v in enumerate(x)]


def odd_vectors(dim, first):
    nan, inf = math.nan, math.inf
    bad = [None, [nan] * dim, [None] + [1.0] * (dim - 1), [inf] + [0.0] * (dim - 1), [-inf] * dim, [1e300] * dim]
    return [(first + 100 * k, v, 1) for k, v in enumerate(bad)]


# -- hard negatives ------------------------------------------------------------------------


def brute_negatives(rows, scale=256):
    usable = [(i, [math.floor(scale * c) for c in v], y) for i, v, y in rows if i is not None and y is not None and v]
    out = []
    for a, q, label in usable:
        if a % 100:
            continue
        scored = [(-sum(p * c for p, c in zip(q, x)), i, y) for i, x, y in usable if i != a and len(x) == len(q)]
        for s, positive, _ in sorted(t for t in scored if t[2] == label)[:5]:
            ps = -s
            fits = sorted(t for t in scored if t[2] != label and 30 * ps <= -100 * t[0] <= 90 * ps)[:10]
            out += [(a, positive, k, i, ps, -t) for k, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(table, **over):
    from pyspark.sql import functions as F
    params = hard_negatives.MiningParams(**over)
    return sorted(tuple(r) for r in hard_negatives.mine(table, F.col("id") % 100 == 0, params).collect())


@pytest.mark.parametrize("dim, labels, over", [
    (5, 3, {}), (64, 2, {"anchors_per_pass": 2}), (70, 4, {"stages": 1, "planes": 2}), (130, 3, {"stages": 5})])
def test_hard_negatives_against_all_scores(spark, dim, labels, over):
    rows = cloud(dim, 420, dim, labels, copies=60)
    want = brute_negatives(rows)
    assert len(want) > 50
    assert mined(table_of(spark, rows).repartition(5), **over) == want


def test_intervals_hold_the_scores_and_filter():
    rng = np.random.default_rng(5)
    params = hard_negatives.MiningParams()
    x = np.floor(256 * rng.normal(size=(3000, 64))).astype(np.int64)
    block = hard_negatives.Block(64, {}, np.arange(3000), np.zeros(3000), x, *hard_negatives.encode(x, params))
    for k in range(20):
        q = hard_negatives.Query(x[k], params)
        low, high = block.intervals(q)
        exact = x @ x[k]
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low).mean() < 0.6 * (np.linalg.norm(x, axis=1) * np.linalg.norm(x[k])).mean()
    zero = hard_negatives.Query(np.zeros(64, dtype=np.int64), params)
    assert (np.abs(np.stack(block.intervals(zero))) < 1).all()


def test_hard_negatives_on_awkward_rows(spark):
    rows = cloud(1, 230, 6, 2)
    odd = [*odd_vectors(6, 1000), (None, rows[0][1], 0), (3000, rows[0][1], None), (3100, [], 0), (3200, [0.0] * 6, 0),
           (3300, rows[5][1][:3], 1), rows[0], (3400, [-c for c in rows[0][1]], 0)]
    usable = [*rows, *[r for r in odd if r[0] in (3200, 3300, 3400)]]
    assert mined(table_of(spark, [*rows, *odd])) == brute_negatives(usable)
    again = [(200, [0.5] * 6, 0)]  # of rows that share an id the least label, then vector, counts
    got = mined(table_of(spark, [*rows[:200], *rows[201:], (200, [9.0] * 6, 1), *again]))
    assert got == brute_negatives([*rows[:200], *rows[201:], *again])
    assert mined(table_of(spark, rows).limit(0)) == []
    assert mined(table_of(spark, [(0, [1.0], 1), (5, [1.0], 2)])) == []


def test_band_includes_its_limits():
    params = hard_negatives.MiningParams()
    for score in range(-40, 400):
        least, most = hard_negatives.band(score, params)
        want = [s for s in range(-100, 400) if 30 * score <= 100 * s <= 90 * score]
        assert [s for s in range(-100, 400) if least <= s <= most] == want


# -- whitening -----------------------------------------------------------------------------


def brute_whitening(rows, dim):
    x = np.array([[math.floor(64 * c) for c in v] for _, v, _ in rows], dtype=object)
    different = np.array(sorted({tuple(v) for v in x}), dtype=object)
    n, total = len(different), different.sum(axis=0)
    centre = lambda v: ((n * v - total) / n).astype(float)
    away = centre(different)
    e, axes = np.linalg.eigh(away.T @ away / n)
    e, axes = e[::-1], axes[:, ::-1]
    k = min(16, int((e > 1e-12 * e[0]).sum()))
    return n, ((n * x - total) ** 2).sum(axis=1), centre(x) @ axes[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def whitened(table, **over):
    out = {}
    for r in whitening.whiten(table, ["vec_id", "rank", "n"], **over).collect():
        out.setdefault(r["vec_id"], {})[r["component"]] = r
    return out


@pytest.mark.parametrize("dim, scale", [(6, 1), (20, 1), (70, 1), (9, 1e6), (9, 1e12)])
def test_whitening_against_numpy(spark, dim, scale):
    rows = [(i, [scale * c + 3 * scale for c in v], y) for i, v, y in cloud(dim, 400, dim, 3, copies=50)]
    n, deviation, want, explained = brute_whitening(rows, dim)
    got = whitened(table_of(spark, [*rows, *odd_vectors(dim, 9000)]).repartition(3))
    k = want.shape[1]
    assert len(got) == len(rows) and all(sorted(got[i]) == [*range(1, k + 1)] for i, _, _ in rows)
    first = got[0][1]
    assert first["n"] == n == 400 and first["identity_error"] < 1e-9
    assert first.asDict().keys() == {"vec_id", "rank", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    assert [got[i][1]["deviation"] for i, _, _ in rows] == [d if d < 1 << 63 else None for d in deviation]
    np.testing.assert_allclose([got[0][c + 1]["explained"] for c in range(k)], explained, rtol=1e-9)
    mine = np.array([[got[i][c + 1]["whitened"] for c in range(k)] for i, _, _ in rows])
    want = want * np.sign((mine * want).sum(axis=0))
    np.testing.assert_allclose(mine, want, atol=1e-7)


def test_whitening_of_missing_rank_and_other_lengths(spark):
    rng = np.random.default_rng(2)
    flat = rng.integers(-50, 50, size=(200, 3)) @ rng.integers(-3, 4, size=(3, 8))
    rows = [(i, (v / 64).tolist(), 0) for i, v in enumerate(flat)]
    other = [(500, [1.0, 2.0], 0), (501, [1.5, 2.0], 0), (502, [], 0), (503, [4.0], 0), (504, [4.0], 1)]
    got = whitened(table_of(spark, rows + other))
    rank = np.linalg.matrix_rank(flat - flat.mean(axis=0))
    n, deviation, want, explained = brute_whitening(rows, 8)
    assert all(len(got[i]) == rank for i, _, _ in rows) and got[0][1]["identity_error"] < 1e-6
    np.testing.assert_allclose([got[0][c + 1]["explained"] for c in range(rank)], explained, rtol=1e-6)
    assert [abs(got[i][1]["whitened"]) for i in (500, 501)] == pytest.approx([1, 1]) and sorted(got[500]) == [1]
    assert not {502, 503, 504} & got.keys()
    assert whitened(table_of(spark, rows).limit(0)) == {}


def test_lattice_vectors_pack_and_unpack():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-(1 << b), 1 << b, size=(20, 5)) for b in (0, 6, 7, 14, 15, 30, 31, 61)])
    keys = whitening.pack(x)
    assert (whitening.unpack(keys, 5) == x).all()
    assert len(set(keys)) == len({tuple(r) for r in x.tolist()})


def test_triangular_solves_undo_the_factors():
    rng = np.random.default_rng(6)
    factors = [np.triu(rng.normal(size=(150, 150)) * 0.05) + np.eye(150) for _ in range(2)]
    x = rng.normal(size=(7, 150))
    np.testing.assert_allclose(whitening.through(x @ factors[1] @ factors[0], [factors[0], factors[1]]), x, atol=1e-6)


# -- embedding join ------------------------------------------------------------------------


def links(table, **over):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_join.near_duplicates(table, **over).collect()}


def test_vectors_of_every_length_and_text_labels(spark):
    rows = [(1, [1.0, 2.0], "x"), (2, [1.0, 2.0], "x"), (3, [1.0, 2.001], "x"), (4, [1.0, 2.0], "y"),
            (5, [1.0, 0.0, 0.0], "x"), (6, [2.0, 0.0, 0.0], "x"), (7, [3.0, 0.0, 0.0], "x"), (8, [0.0, 0.0, 0.0], "x"),
            (9, [1.0], "x"), (10, [-1.0], "x"), (11, [], "x"), (12, [5.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert links(table) == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (2, 5), 6: (2, 5), 7: (2, 5), 8: (0, 8),
                            9: (1, 9), 10: (0, 10), 11: (0, 11), 12: (1, 9)}


def test_cosines_are_compared_in_double_precision(spark):
    def at(cosine):
        return [cosine, math.sqrt(1 - cosine * cosine)]

    rows = [(1, [1.0, 0.0], 1 << 40), (2, at(0.98 - 1e-10), 1 << 40), (3, [1.0, 0.0], 2), (4, at(0.98 + 1e-10), 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    assert links(table) == {1: (0, 1), 2: (0, 2), 3: (1, 3), 4: (1, 3)}


def test_blocks_are_numbered_within_labels_across_tasks(spark):
    rows = [(t, p, y) for y, t, n in (("a", 0, 3), ("a", 1, 2), ("b", 1, 1), ("b", 4, 2)) for p in range(n)]
    got = embedding_join._numbered(spark.createDataFrame([(*r[:2], r[2]) for r in rows], "task int, place int, label string"))
    by = {y: sorted(r["at"] for r in got.collect() if r["label"] == y) for y in "ab"}
    assert by == {"a": [0, 1, 2, 3, 4], "b": [0, 1, 2]}
