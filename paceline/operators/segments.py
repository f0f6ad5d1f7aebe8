"""Behavioural segments: user features, scaling, k-means sweep, silhouette, profile."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from paceline.functions.time import elapsed_days
from paceline.sources.scratch import written
from paceline.spec import DEFAULT_FUNNEL, FunnelSpec

FEATURES = ["days_since_signup", "max_funnel_depth", "bounce_rate", "total_sessions",
            "avg_duration", "total_purchase", "cart_additions"]

# Mean pairwise distance is quadratic: it is scored on at most this many users.
SILHOUETTE_SAMPLE = 10_000
# Fixed value: the most iterations of one fit; fits stop earlier when centres settle.
MAX_ITERATIONS = 300
# Rounds in which starting centres are drawn from all users, and rows drawn per round and cluster.
SEED_ROUNDS, SEED_FACTOR = 3, 2.0
_BLOCK = 512


def user_features(sessions: DataFrame, spec: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Seven features per user."""
    depth = sum((F.col(s.reached_col) if s.as_flag else F.col(s.reached_col) > 0).cast("int")
                for s in spec.steps)
    cart, bought = spec.steps[-3].reached_col, spec.steps[-1].reached_col
    return sessions.where(F.col(spec.user).isNotNull()).groupBy(spec.user).agg(
        F.max(elapsed_days(F.col("user_signup_date"), F.col("session_start"))).alias("days_since_signup"),
        F.max(depth).cast("long").alias("max_funnel_depth"),
        F.avg((F.col("total_events") <= 1).cast("int")).alias("bounce_rate"),
        F.count_distinct(spec.session).alias("total_sessions"),
        F.avg("session_duration").alias("avg_duration"),
        F.sum(F.col(bought).cast("long")).alias("total_purchase"),
        F.sum(cart).alias("cart_additions"),
    )


def standardize(df: DataFrame, cols: Sequence[str], prefix: str = "") -> DataFrame:
    """z-scores with the population deviation; a constant column becomes zero.

    They replace the columns, or stand beside them under ``prefix``. The means and
    deviations are one row, read by a scalar subquery: ``df`` is computed twice, so pass
    a written table if that is costly.
    """
    stats = df.select(F.struct(*[f(c).alias(f"{p}_{c}") for c in cols
                                 for p, f in (("mean", F.avg), ("sd", F.stddev_pop))])).scalar()

    def z(c: str) -> Column:
        sd = F.col(f"_stats.sd_{c}")
        scaled = (F.col(c) - F.col(f"_stats.mean_{c}")) / F.when(sd == 0, 1.0).otherwise(sd)
        return scaled.alias(prefix + c)

    kept = [c for c in df.columns if prefix or c not in cols]
    return df.withColumn("_stats", stats).select(*kept, *[z(c) for c in cols])


def hash_sample(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """A repeatable random sample of ``n`` rows: the smallest hashes of the id."""
    return df.orderBy(F.md5(F.col(id_col).cast("string")), id_col).limit(n)


def silhouette_points(df: DataFrame, id_col: str, vector: str, labels: Sequence[str],
                      n: int = SILHOUETTE_SAMPLE) -> DataFrame:
    """Exact Euclidean silhouette of each sampled point, a row per (labelling, point).

    The sample (at most ``n`` rows, by definition of the score) is shared with all tasks;
    each task takes a block of points and emits one number per point, never pairs.
    """
    spark = df.sparkSession
    whole = df.dropna(subset=[vector, *labels]).select(
        F.col(id_col), F.col(vector).cast("array<double>").alias("v"), *labels)
    sample = hash_sample(whole, id_col, n).toPandas()
    points = np.array(sample["v"].tolist(), dtype=np.float64).reshape(len(sample), -1 if len(sample) else 0)
    codes = {c: np.unique(sample[c].to_numpy(), return_inverse=True)[1] for c in labels}
    shared = spark.sparkContext.broadcast((points, codes))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pts, by_label = shared.value
        square = (pts * pts).sum(axis=1)
        members = {c: np.eye(int(k.max()) + 1)[k] for c, k in by_label.items()}
        for batch in batches:
            for at in range(0, len(batch), _BLOCK):
                rows = batch["i"].to_numpy()[at:at + _BLOCK]
                gap = square[rows, None] + square[None, :] - 2.0 * pts[rows] @ pts.T
                dist = np.sqrt(np.maximum(gap, 0.0))
                dist[np.arange(len(rows)), rows] = 0.0
                for c, k in by_label.items():
                    size = members[c].sum(axis=0)
                    total = dist @ members[c]
                    own = k[rows]
                    peers = size[own] - 1
                    me = np.arange(len(rows))
                    inside = total[me, own] / np.maximum(peers, 1)
                    mean = total / size
                    mean[me, own] = np.inf
                    nearest = mean.min(axis=1)
                    top = np.maximum(inside, nearest)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        s = np.where((peers > 0) & (top > 0), (nearest - inside) / top, 0.0)
                    yield pd.DataFrame({"labelling": c, "point": rows, "cluster": own, "silhouette": s})

    blocks = max(1, min(len(sample) // _BLOCK + 1, spark.sparkContext.defaultParallelism * 4))
    index = spark.range(0, len(sample), 1, blocks).select(F.col("id").alias("i"))
    return index.mapInPandas(score, "labelling string, point long, cluster long, silhouette double")


def silhouette_sampled(df: DataFrame, id_col: str, vector: str, labels: Sequence[str],
                       n: int = SILHOUETTE_SAMPLE) -> DataFrame:
    """Mean silhouette per labelling; NULL when a labelling has a single cluster."""
    scored = silhouette_points(df, id_col, vector, labels, n).groupBy("labelling").agg(
        F.count(F.lit(1)).alias("points"),
        F.count_distinct("cluster").alias("clusters"),
        F.avg("silhouette").alias("mean"),
    )
    return scored.select("labelling", "points", "clusters",
                         F.when(F.col("clusters") > 1, F.round("mean", 5)).alias("silhouette"))


def silhouette_squared(df: DataFrame, vector: str, label: str) -> float:
    """Squared-Euclidean silhouette of *all* rows in one linear pass.

    A different number from the Euclidean one above: use it to compare labellings of a
    population too large to trust a sample, not against published scores.
    """
    return ClusteringEvaluator(featuresCol=vector, predictionCol=label).evaluate(df)


def silhouette_all(df: DataFrame, vector: str, labels: Sequence[str]) -> DataFrame:
    """``silhouette_squared`` of several labellings of an array column; rows without vector or
    label are left out, and a labelling with fewer than two clusters scores NULL."""
    rows = []
    for c in labels:
        known = df.dropna(subset=[vector, c]).select(
            array_to_vector(F.col(vector).cast("array<double>")).alias("v"), F.col(c).cast("double").alias("label"))
        several = known.select("label").distinct().limit(2).count() > 1
        rows.append((c, round(silhouette_squared(known, "v", "label"), 5) if several else None))
    return df.sparkSession.createDataFrame(rows, "labelling string, silhouette double")


def _seeds(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator, tries: int = 8,
           rounds: int = 20) -> np.ndarray:
    """``k`` centres of few weighted points: the cheapest of some k-means++ draws with weighted Lloyd rounds."""
    def gaps(centres):
        return ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)

    best, least = None, np.inf
    for _ in range(tries):
        centres = points[[rng.choice(len(points), p=weights / weights.sum())]]
        while len(centres) < k:
            mass = gaps(centres).min(axis=1) * weights
            pick = rng.choice(len(points), p=mass / mass.sum()) if mass.sum() > 0 else rng.integers(len(points))
            centres = np.concatenate([centres, points[[pick]]])
        for _ in range(rounds):
            own = gaps(centres).argmin(axis=1)
            mass = np.bincount(own, weights=weights, minlength=k)[:, None]
            sums = np.stack([np.bincount(own, weights=weights * x, minlength=k) for x in points.T], axis=1)
            centres = np.where(mass > 0, sums / np.maximum(mass, 1e-300), centres)
        cost = float((gaps(centres).min(axis=1) * weights).sum())
        if cost < least:
            best, least = centres, cost
    return best


def _drawn(vectors: DataFrame, id_col: str, cols: Sequence[str], centres: dict[int, np.ndarray], rate: dict[int, float],
           salt: int) -> pd.DataFrame:
    """For each fit the rows drawn with chance rate x squared distance to its centres; the draw hangs on the id."""
    cols = list(cols)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[cols].to_numpy(dtype=np.float64)
            h = batch["_h"].to_numpy().view(np.uint64)
            square = (x * x).sum(axis=1)
            for f, c in centres.items():
                with np.errstate(over="ignore"):
                    u = (h ^ np.uint64(0x9E3779B97F4A7C15) * np.uint64(1 + f)) * np.uint64(0xBF58476D1CE4E5B9)
                    u = (u ^ (u >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
                gap = np.maximum((square[:, None] - 2.0 * x @ c.T + (c * c).sum(axis=1)).min(axis=1), 0.0)
                at = np.flatnonzero((u >> np.uint64(11)) * 2.0 ** -53 < rate[f] * gap)
                if len(at):
                    yield pd.DataFrame({"fit": f, **{name: x[at, j] for j, name in enumerate(cols)}})

    rows = vectors.select(F.xxhash64(F.lit(salt), id_col).alias("_h"), *cols)
    return rows.mapInPandas(draw, "fit int, " + ", ".join(f"`{c}` double" for c in cols)).toPandas()


def parallel_seeds(vectors: DataFrame, id_col: str, cols: Sequence[str], size: dict[int, int], seed: int, *,
                   rounds: int = SEED_ROUNDS, factor: float = SEED_FACTOR) -> dict[int, np.ndarray]:
    """Starting centres of all fits (``size``: clusters of each) by oversampling over every row.

    Each round draws some ``factor`` x clusters rows for a fit, far ones likelier; the rows drawn
    are weighed by the rows nearest to them and reduced to as many centres as the fit has
    clusters. All fits share the passes; the driver gets the rows drawn, some dozens a fit.
    """
    first = hash_sample(vectors.select(id_col, *cols), id_col, len(size)).toPandas()[list(cols)].to_numpy(dtype=np.float64)
    if not len(first):
        return {}
    drawn = {f: first[f % len(first)][None, :] for f in size}
    for r in range(rounds):
        cost = _cluster_sums(vectors, cols, drawn).groupby("fit")["cost"].sum()
        rate = {f: factor * size[f] / cost[f] if cost[f] > 0 else 0.0 for f in size}
        got = _drawn(vectors, id_col, cols, drawn, rate, seed * 1000 + r)
        for f, rows in got.groupby("fit"):
            drawn[f] = np.concatenate([drawn[f], np.unique(rows[list(cols)].to_numpy(dtype=np.float64), axis=0)])
    weights = _cluster_sums(vectors, cols, drawn).set_index(["fit", "cluster"])["n"]
    return {f: _seeds(points, np.maximum(weights.loc[f].sort_index().to_numpy(), 1e-9), size[f], np.random.default_rng([seed, f]))
            for f, points in drawn.items()}


def _cluster_sums(vectors: DataFrame, cols: Sequence[str], centres: dict[int, np.ndarray]) -> pd.DataFrame:
    """Rows, cost and coordinate sums per (fit, cluster) for all given fits, in one pass.

    A task sends one row per (fit, cluster), whatever number of rows it reads.
    """
    cols, width = list(cols), len(cols)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = {f: np.zeros(len(c)) for f, c in centres.items()}
        cost = {f: np.zeros(len(c)) for f, c in centres.items()}
        sums = {f: np.zeros(c.shape) for f, c in centres.items()}
        for batch in batches:
            x = batch[cols].to_numpy(dtype=np.float64)
            square = (x * x).sum(axis=1)
            for f, c in centres.items():
                gap = np.maximum(square[:, None] - 2.0 * x @ c.T + (c * c).sum(axis=1), 0.0)
                own = gap.argmin(axis=1)
                member = np.eye(len(c))[own]
                n[f] += member.sum(axis=0)
                cost[f] += np.bincount(own, weights=gap[np.arange(len(x)), own], minlength=len(c))
                sums[f] += member.T @ x
        yield pd.DataFrame([(f, j, n[f][j], cost[f][j], *sums[f][j]) for f, c in centres.items() for j in range(len(c))],
                           columns=["fit", "cluster", "n", "cost", *[f"s{i}" for i in range(width)]])

    totals = ["n", "cost", *[f"s{i}" for i in range(width)]]
    parts = vectors.select(*cols).mapInPandas(
        add_up, "fit int, cluster int, " + ", ".join(f"{c} double" for c in totals))
    return parts.groupBy("fit", "cluster").agg(*[F.sum(c).alias(c) for c in totals]).toPandas()


def kmeans_fits(vectors: DataFrame, id_col: str, cols: Sequence[str], ks: Sequence[int], restarts: int, seed: int,
                *, max_iterations: int = MAX_ITERATIONS,
                tolerance: float = 1e-4) -> dict[int, tuple[float, np.ndarray, bool]]:
    """Per k the cheapest of ``restarts`` fits: ``(cost, centres, settled)``.

    All fits advance together, one pass over ``vectors`` per iteration; each leaves when no
    centre moves by more than ``tolerance``. Every row takes part in drawing the starting centres
    and in every iteration. No row, no fit.
    """
    size = {i * restarts + r: k for i, k in enumerate(ks) for r in range(restarts)}
    centres = parallel_seeds(vectors, id_col, cols, size, seed)
    if not centres:
        return {}
    moving = set(size)
    for _ in range(max_iterations):
        if not moving:
            break
        sums = _cluster_sums(vectors, cols, {f: centres[f] for f in moving}).set_index(["fit", "cluster"])
        for f in list(moving):
            moved = centres[f].copy()
            for j in range(size[f]):
                row = sums.loc[(f, j)]
                if row["n"] > 0:  # a centre without rows stays where it is
                    moved[j] = row.iloc[2:].to_numpy() / row["n"]
            if ((moved - centres[f]) ** 2).sum(axis=1).max() <= tolerance ** 2:
                moving.discard(f)
            centres[f] = moved
    costs = _cluster_sums(vectors, cols, centres).groupby("fit")["cost"].sum()
    best = {k: min((costs[f], f) for f in size if size[f] == k) for k in ks}
    return {k: (float(cost), centres[f], f not in moving) for k, (cost, f) in best.items()}


def _square_gap(cols: Sequence[str], centre: Sequence[float]) -> Column:
    return reduce(lambda a, b: a + b, [(F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(cols, centre)])


def nearest_centre(cols: Sequence[str], centres: np.ndarray) -> Column:
    """Place of the nearest centre, the first of equals."""
    gaps = F.array(*[_square_gap(cols, c) for c in centres])
    return (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")


def kmeans_labels(features: DataFrame, id_col: str, cols: Sequence[str] = FEATURES, ks: Sequence[int] = (2, 3, 4, 5),
                  restarts: int = 10, seed: int = 42) -> tuple[DataFrame, dict[int, tuple[float, np.ndarray, bool]]]:
    """``features`` with scaled columns ``z_…`` and a label ``k…`` per k, written; and the fits."""
    z = [f"z_{c}" for c in cols]
    scaled = written(standardize(written(features, "user_features"), cols, prefix="z_"), "scaled_users")
    fits = kmeans_fits(scaled, id_col, z, ks, restarts, seed)
    labels = [(nearest_centre(z, fits[k][1]) if k in fits else F.lit(None).cast("int")).alias(f"k{k}") for k in ks]
    return written(scaled.select("*", F.array(*z).alias("vector"), *labels), "labelled_users"), fits


def kmeans_sweep(features: DataFrame, id_col: str, cols: Sequence[str] = FEATURES,
                 ks: Sequence[int] = (2, 3, 4, 5), restarts: int = 10, seed: int = 42,
                 sample: int = SILHOUETTE_SAMPLE) -> tuple[DataFrame, DataFrame]:
    """k-means for each ``k``, best of ``restarts`` by cost; the best k by silhouette.

    Returns the scores ``(k, training_cost, settled, silhouette, best)`` and ``features``
    with the best labelling as ``cluster``. ``settled`` is false if the fit still moved when
    iterations ran out; costs are NULL without users.
    """
    labelled, fits = kmeans_labels(features, id_col, cols, ks, restarts, seed)
    scores = {
        r["labelling"]: r["silhouette"]
        for r in silhouette_sampled(labelled, id_col, "vector", [f"k{k}" for k in ks], sample).collect()
    }
    known = [k for k in ks if scores.get(f"k{k}") is not None]
    chosen = max(known, key=lambda k: scores[f"k{k}"], default=ks[0])
    table = features.sparkSession.createDataFrame(
        [(k, *(fits[k][::2] if k in fits else (None, None)), scores.get(f"k{k}"), k == chosen) for k in ks],
        "k int, training_cost double, settled boolean, silhouette double, best boolean",
    )
    return table, labelled.select(id_col, *cols, F.col(f"k{chosen}").alias("cluster"))


def kmeans_check(features: DataFrame, id_col: str, cols: Sequence[str] = FEATURES,
                 ks: Sequence[int] = (2, 3, 4, 5), restarts: int = 10, seed: int = 42) -> DataFrame:
    """What must hold for every k, a row each: users labelled, clusters in use, whether the fit
    settled, clusters whose centre is not the mean of its members, whether the cost is no higher
    than for fewer clusters, and each feature's mean put together from the clusters."""
    labelled, fits = kmeans_labels(features, id_col, cols, ks, restarts, seed)
    rows = []
    for i, k in enumerate(ks):
        cost, centres, settled = fits.get(k, (0.0, np.zeros((k, len(cols))), True))
        falling = i == 0 or cost <= fits.get(ks[i - 1], (0.0,))[0] + 1e-9
        fitted = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
        at = F.get(fitted, F.col(f"k{k}"))
        off = reduce(lambda a, b: a | b, [F.abs(F.col(f"m{j}") - F.col("at")[j]) > 0.01 for j in range(len(cols))])
        groups = labelled.groupBy(f"k{k}").agg(
            F.count(F.lit(1)).alias("n"), F.first(at).alias("at"),
            *[F.avg(f"z_{c}").alias(f"m{j}") for j, c in enumerate(cols)], *[F.avg(c).alias(c) for c in cols])
        rows.append(groups.agg(
            F.lit(k).alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("users"),
            F.count(f"k{k}").alias("clusters"), F.lit(settled).alias("settled"),
            F.count_if(off).alias("displaced_centres"), F.lit(falling).alias("cost_falls"),
            *[F.round(F.sum(F.col(c) * F.col("n")) / F.sum("n"), 4).alias(c) for c in cols]))
    return reduce(DataFrame.unionByName, rows)


def segment_profile(df: DataFrame, label: str, cols: Sequence[str] = FEATURES) -> DataFrame:
    """Size and mean of every feature per segment."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("users"),
        *[F.round(F.avg(c), 6).alias(c) for c in cols if c != label],
    )
