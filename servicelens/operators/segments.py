"""Asset activity features, standardisation, K-Means segmentation, profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from servicelens.functions.exprs import money
from servicelens.params import Params
from servicelens.session import cut_lineage

MIN_ACTIVE_DAYS = 30
#: Points that first centres are drawn from; passes over the points, and the move of a centre that ends a fit.
SAMPLE, MOST_SWEEPS, CLOSE = 10_000, 100, 1e-6
#: Points that a task of a pass reads (fewer make tasks that only start and end), and of which it holds all distances at once.
POINTS_A_TASK, POINTS_AT_ONCE = 10_000, 1_000
# The columns that the clustering reads.
FILL_ZERO = ("visits", "anchor_visits", "revenue", "avg_items", "visits_per_year", "revenue_per_year",
             "avg_gap_days", "avg_gap_km")
X_COLS = ("km_per_month", "interval_km", "model_year", "visits_per_year", "revenue_per_year", "avg_items",
          "avg_gap_days")


def car_activity(visits: DataFrame) -> DataFrame:
    """Per asset visits, anchor visits, revenue, mean items, dates, annualised rates."""
    a = (visits.where(F.col("asset_id").isNotNull()).groupBy("asset_id").agg(
        F.count(F.lit(1)).alias("visits"),
        F.count_if(F.col("has_anchor")).alias("anchor_visits"),
        F.sum(money("visit_revenue")).cast("double").alias("revenue"),
        F.avg("n_items").alias("avg_items"),
        F.min("visit_date").alias("first_visit"),
        F.max("visit_date").alias("last_visit")))
    return (a.withColumn("active_days", F.greatest(F.datediff("last_visit", "first_visit"), F.lit(MIN_ACTIVE_DAYS)))
            .withColumn("visits_per_year", F.col("visits") / F.col("active_days") * F.lit(365.0))
            .withColumn("revenue_per_year", F.col("revenue") / F.col("active_days") * F.lit(365.0)))


def gap_means(episodes: DataFrame) -> DataFrame:
    """Mean episode gap (days, km) per asset."""
    return episodes.groupBy("asset_id").agg(F.avg("gap_days").alias("avg_gap_days"),
                                            F.avg("gap_km").alias("avg_gap_km"))


def feature_table(assets: DataFrame, visits: DataFrame, episodes: DataFrame) -> DataFrame:
    """C4: master + activity + gap means; activity NULL -> 0, non-finite model inputs -> 0."""
    f = assets.join(car_activity(visits), "asset_id", "left").join(gap_means(episodes), "asset_id", "left")
    for c in FILL_ZERO:
        f = f.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    for c in X_COLS:
        x = F.col(c).cast("double")
        f = f.withColumn(f"x_{c}", F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x))
    return f


def standardized(features: DataFrame) -> DataFrame:
    """C5 (exact form): z-scores with the population standard deviation (one global aggregate)."""
    stats = features.agg(*[F.avg(f"x_{c}").alias(f"m_{c}") for c in X_COLS],
                         *[F.stddev_pop(f"x_{c}").alias(f"s_{c}") for c in X_COLS])
    out = features.select("asset_id", *[f"x_{c}" for c in X_COLS])
    for c in X_COLS:
        m = stats.select(f"m_{c}").scalar()
        s = stats.select(f"s_{c}").scalar()
        out = out.withColumn(f"z_{c}", F.when(s == 0, F.lit(0.0)).otherwise((F.col(f"x_{c}") - m) / s))
    return out.select("asset_id", *[f"z_{c}" for c in X_COLS])


def _points(features: DataFrame) -> DataFrame:
    """Features with ``z``, the array of their z-scores (population standard deviation; 0 where all are equal).

    Dealt out anew by the number of points: what the joins before leave is as
    many partitions as the session shuffles to, each paid for in every pass.
    """
    got = features.agg(F.count(F.lit(1)).alias("n"), *[f(f"x_{c}").alias(f"{n}_{c}") for c in X_COLS for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    z = [(F.col(f"x_{c}") - F.lit(got[f"m_{c}"] or 0.0)) / F.lit(got[f"s_{c}"]) if got[f"s_{c}"] else F.lit(0.0) for c in X_COLS]
    return features.withColumn("z", F.array(*z)).repartition(max(1, -(-got["n"] // POINTS_A_TASK)))


def first_centers(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over the sample: each next centre is drawn by its squared distance to the nearest one."""
    rng = np.random.default_rng(seed)
    centers = [sample[rng.integers(len(sample))]]
    near = np.sum((sample - centers[0]) ** 2, 1)
    while len(centers) < k:
        total = near.sum()
        centers.append(sample[rng.choice(len(sample), p=near / total if total > 0 else None)])
        near = np.minimum(near, np.sum((sample - centers[-1]) ** 2, 1))
    return np.array(centers)


def sweep(points: DataFrame, centers: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(members, sums of members, cost) for each of several sets of centres, in one pass over ``z``.

    A task gives one row of numbers for its partition; these are added by
    position, so what moves is the size of the models.
    """
    fits, most, d = len(centers), max(map(len, centers)), centers[0].shape[1]
    # all centres as one block, by place and fit; a place that a fit lacks is infinitely far away
    every, square = np.zeros((most, fits, d)), np.full((most, fits), np.inf)
    for j, c in enumerate(centers):
        every[:len(c), j], square[:len(c), j] = c, np.sum(c**2, 1)
    every, square = every.reshape(-1, d), square.reshape(-1, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, cost = np.zeros((most * fits, d + 1)), np.zeros(fits)
        for batch in batches:
            points = batch.column("z").flatten().to_numpy().reshape(batch.num_rows, d)
            for at in range(0, len(points), POINTS_AT_ONCE):
                z = points[at:at + POINTS_AT_ONCE]
                away = (np.sum(z**2, 1) - 2 * every @ z.T + square).reshape(most, fits, -1)
                least = away.min(0)
                own = away == least
                taken = own[0].copy()
                for place in own[1:]:  # the first of equal ones
                    place &= ~taken
                    taken |= place
                total += own.reshape(most * fits, -1).astype(float) @ np.column_stack([np.ones(len(z)), z])
                cost += np.maximum(least, 0.0).sum(1)
        yield pa.RecordBatch.from_pydict({"v": pa.array([[*total.ravel().tolist(), *cost.tolist()]], pa.list_(pa.float64()))})

    parts = points.select("z").mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("at", "v"))
    got = {r["at"]: r["v"] for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect()}
    flat = np.array([got[i] for i in range(most * fits * (d + 1) + fits)])
    total, cost = flat[:-fits].reshape(most, fits, d + 1), flat[-fits:]
    return [(total[:len(c), j, 0], total[:len(c), j, 1:], float(cost[j])) for j, c in enumerate(centers)]


def fit_many(points: DataFrame, starts: dict) -> tuple[dict, int]:
    """Lloyd's iterations of several fits side by side: ({job: (centres, cost)}, passes).

    One pass over the points moves the centres of every fit that still moves;
    a centre without members stays where it is.
    """
    centers, cost, moving, passes = dict(starts), {}, list(starts), 0
    while moving and passes < MOST_SWEEPS:
        got = sweep(points, [centers[j] for j in moving])
        passes += 1
        still = []
        for j, (members, sums, c) in zip(moving, got):
            new = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None], centers[j])
            if np.max(np.abs(new - centers[j])) > CLOSE:
                still.append(j)
            centers[j], cost[j] = new, c
        moving = still
    return {j: (centers[j], cost[j]) for j in centers}, passes


def nearest(centers: np.ndarray) -> Column:
    """The number of the centre nearest to ``z`` (the first of equal ones), as an expression."""
    away = F.array(*[sum((F.col("z")[j] - F.lit(float(x))) ** 2 for j, x in enumerate(c)) for c in centers])
    return (F.array_position(away, F.array_min(away)) - 1).cast("int")


def cluster_run(features: DataFrame, params: Params, ks=(3, 4, 5)):
    """C6-C7 in one go: every (k, restart) is fitted side by side.

    C6: for each k the best of ``kmeans_restarts`` seeds (lowest cost), then
    the k with the best silhouette (Spark's, squared Euclidean).
    C7: of the chosen k the best of ``kmeans_final_restarts`` seeds. A fit
    depends on (k, seed) alone; its first centres come from the SAMPLE points
    of the lowest hashes. Returns (k, silhouette, k table, labelled features).
    """
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    held = features.persist(StorageLevel.MEMORY_AND_DISK)  # read for the means, then for the points
    data = _points(held).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sample = np.array([r["z"] for r in data.orderBy(F.xxhash64(F.col("asset_id").cast("string")), "asset_id").select("z").limit(SAMPLE).collect()])
        held.unpersist()
        if not len(sample):
            raise ValueError("there is no asset to cluster")
        seeds = [params.seed + i for i in range(max(params.kmeans_restarts, params.kmeans_final_restarts))]
        fits, _ = fit_many(data, {(k, s): first_centers(sample, k, s) for k in ks for s in seeds})
        best = lambda k, n: min(((fits[k, s][1], s) for s in seeds[:n]))[1]
        ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
        rows, best_k, best_s = [], ks[0], -1.0
        for k in ks:
            centers, cost = fits[k, best(k, params.kmeans_restarts)]
            sil = ev.evaluate(data.select(array_to_vector("z").alias("features"), nearest(centers).cast("double").alias("cluster")))
            rows.append((k, float(sil), cost))
            if sil > best_s:
                best_k, best_s = k, sil
        labelled = data.withColumn("cluster", nearest(fits[best_k, best(best_k, params.kmeans_final_restarts)][0])).drop("z")
        order = labelled.groupBy("cluster").agg(F.avg("revenue_per_year").alias("r"))
        order = order.select("cluster", (F.row_number().over(Window.orderBy(F.desc("r"), "cluster")) - 1).alias("cluster_id"))
        # the labels are written once: every table made from them shares this fit
        labelled = cut_lineage(labelled.join(F.broadcast(order), "cluster").drop("cluster"))
    finally:
        held.unpersist()
        data.unpersist()
    table = features.sparkSession.createDataFrame(rows, "k int, silhouette double, training_cost double")
    return best_k, best_s, table, labelled


def group_profile(labelled: DataFrame, label: str, silhouette: float | None = None) -> DataFrame:
    """Per group: assets, means of the activity features, dominant hidden segment (+ the fit's silhouette)."""
    prof = labelled.groupBy(label).agg(
        F.count_distinct("asset_id").alias("assets"),
        F.avg("km_per_month").alias("avg_km_per_month"),
        F.avg("visits_per_year").alias("avg_visits_per_year"),
        F.avg("revenue_per_year").alias("avg_revenue_per_year"),
        F.avg("avg_gap_days").alias("avg_gap_days"),
        F.avg("anchor_visits").alias("avg_anchor_visits"))
    seg = (labelled.groupBy(label, "segment").agg(F.count(F.lit(1)).alias("n"))
           .groupBy(label).agg(F.max_by("segment", F.struct("n", F.col("segment"))).alias("top_segment")))
    out = prof.join(seg, label, "left")
    if silhouette is not None:
        out = out.withColumn("silhouette", F.lit(silhouette))
    return out.orderBy(F.desc("avg_revenue_per_year"))


def cluster_crosstab(labelled: DataFrame) -> DataFrame:
    """Cluster x segment, shares normalised by row (long form, zero cells included)."""
    # clusters and segments are two short lists; their grid holds the empty cells too
    c = labelled.where(F.col("segment").isNotNull()).groupBy("cluster_id", "segment").agg(F.count(F.lit(1)).alias("n"))
    tot = c.groupBy("cluster_id").agg(F.sum("n").alias("t"))
    segs = c.agg(F.array_sort(F.collect_set("segment"))).scalar()
    grid = tot.select("cluster_id", "t", F.explode(segs).alias("segment"))
    return (grid.join(c, ["cluster_id", "segment"], "left")
            .select("cluster_id", "segment", (F.coalesce("n", F.lit(0)) / F.col("t")).alias("share")))


def segment_crosstab(labelled: DataFrame) -> DataFrame:
    """C11: segment x cluster raw counts (pivot; cluster ids are a small bounded set)."""
    return labelled.groupBy("segment").pivot("cluster_id").agg(F.count(F.lit(1))).na.fill(0)
