"""Recommender operators.

Collaborative filtering: the centred user × item rating matrix is factorised
by distributed truncated SVD (``linalg.truncated_svd``); predictions are
``clip(mean + (UΣ)_u · V_i, 1, 5)``.  Content-based: items are min-max
scaled feature vectors; cosine similarity is the dot product of unit
vectors, and a user's score for item j, Σ_{i∈history} cos(i, j), equals
(Σ_i unit_i) · unit_j, so no item × item table is ever built.
"""
from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.exprs import exact_mean, hash_bucket
from ..sources.shared import materialised
from . import linalg
from .scoring import top_n_dot

REC_COLUMNS = ["user_id", "rank", "product_id", "score"]


# ---------------------------------------------------------------------------
# M1 split
# ---------------------------------------------------------------------------

def split_flag(pairs: DataFrame, test_size: float = S.TEST_SIZE, seed: int = S.RANDOM_STATE) -> DataFrame:
    """M1: adds ``is_test``; a pair is held out when the md5 bucket of
    (seed, user, item) falls below ``test_size``·100.  Reproducible on any
    partitioning and computable in plain SQL."""
    cut = int(round(test_size * 100))
    return pairs.withColumn("is_test", hash_bucket(seed, "user_id", "product_id") < F.lit(cut))


def split_train_test(pairs: DataFrame, test_size: float = S.TEST_SIZE, seed: int = S.RANDOM_STATE):
    flagged = split_flag(pairs, test_size, seed)
    return (flagged.where(~F.col("is_test")).drop("is_test"),
            flagged.where(F.col("is_test")).drop("is_test"))


# ---------------------------------------------------------------------------
# M2–M6 collaborative filtering
# ---------------------------------------------------------------------------

def rating_matrix(train: DataFrame) -> DataFrame:
    """M2: stored cells (user_id, product_id, value) with a rating > 0."""
    return (train.where(F.col("avg_rating") > 0)
                 .select("user_id", "product_id", F.col("avg_rating").cast("double").alias("value")))


def mean_center(cells: DataFrame) -> DataFrame:
    """M3: subtract the mean of the stored (non-zero) cells."""
    mean = cells.select(exact_mean("value")).scalar()
    return cells.select("user_id", "product_id", (F.col("value") - mean).alias("value"))


@dataclass
class SVDModel:
    global_mean: float
    user_factors: DataFrame      # (user_id, vec) = U_k Σ_k rows of all users of the training pairs
    item_factors: DataFrame      # (product_id, vec) = V_k rows of all items of the training pairs
    sigma: list
    n_factors: int
    n_users: int
    n_items: int


def svd_fit(train: DataFrame, n_factors: int = S.N_FACTORS, block: int | None = None, tol: float = linalg.TOLERANCE,
            seed: int = S.RANDOM_STATE, tile: int = linalg.TILE, folder: str | None = None) -> SVDModel:
    """M4: truncated SVD of the mean-centred rating matrix, k = min(n_factors, min(U, I) - 1).

    Known users/items are all ids of the training pairs (click-only pairs are
    zero cells: their users/items exist in the model with zero factors).  The
    factor tables hold a vector for every known id and are written to the
    shared folder, so scoring, prediction and saving do not replay the fit.
    With ``folder`` a fit that was stopped goes on after its last written pass.
    """
    train = materialised(train.select("user_id", "product_id", "avg_rating"), "svd-train")
    counts = train.agg(F.count_distinct("user_id").alias("u"), F.count_distinct("product_id").alias("i"),
                       F.avg(F.when(F.col("avg_rating") > 0, F.col("avg_rating"))).alias("m")).first()
    n_users, n_items = int(counts["u"]), int(counts["i"])
    mean = float(counts["m"]) if counts["m"] is not None else 0.0
    k = max(0, min(n_factors, min(n_users, n_items) - 1))
    cells = rating_matrix(train).select("user_id", "product_id", (F.col("value") - F.lit(mean)).alias("value"))
    users, items = train.select("user_id").distinct(), train.select("product_id").distinct()
    if k == 0 or not cells.where("value <> 0").head(1):
        none = F.array().cast("array<double>").alias("vec")
        return SVDModel(mean, users.select("user_id", none), items.select("product_id", none), [], 0, n_users, n_items)
    uf, vf, sigma = linalg.truncated_svd(cells, "user_id", "product_id", k, block=block, tol=tol, seed=seed, tile=tile,
                                         folder=folder)

    def all_known(ids: DataFrame, factors: DataFrame, key: str) -> DataFrame:
        zero = F.array_repeat(F.lit(0.0), len(sigma))
        return materialised(ids.join(factors, key, "left").select(key, F.coalesce("vec", zero).alias("vec")),
                            "svd-factors")
    return SVDModel(mean, all_known(users, uf, "user_id"), all_known(items, vf, "product_id"),
                    [float(x) for x in sigma], len(sigma), n_users, n_items)


def mean_deviation_model(train: DataFrame) -> SVDModel:
    """A model with one factor per id: the deviation of the user's and the
    item's mean rating from the global mean (0 for ids without a rating), all
    rounded to six decimals.  A baseline that plain SQL can reproduce."""
    train = materialised(train.select("user_id", "product_id", "avg_rating"), "deviation-train")
    cells = rating_matrix(train)
    facts = train.agg(F.count_distinct("user_id").alias("u"), F.count_distinct("product_id").alias("i"),
                      F.round(F.avg(F.when(F.col("avg_rating") > 0, F.col("avg_rating"))), 6).alias("m")).first()
    mean = float(facts["m"]) if facts["m"] is not None else 0.0

    def factors(key: str) -> DataFrame:
        dev = cells.groupBy(key).agg(F.round(F.avg("value") - F.lit(mean), 6).alias("f"))
        return materialised(train.select(key).distinct().join(dev, key, "left").select(
            key, F.array(F.coalesce("f", F.lit(0.0))).alias("vec")), "deviation-factors")
    return SVDModel(mean, factors("user_id"), factors("product_id"), [1.0], 1, int(facts["u"]), int(facts["i"]))


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def predict_pairs(model: SVDModel, pairs: DataFrame) -> DataFrame:
    """M5: prediction per (user_id, product_id); unknown user or item -> the
    global mean (unclipped), known -> clip(mean + u·v, 1, 5)."""
    p = (pairs.select("user_id", "product_id")
              .join(model.user_factors.withColumnRenamed("vec", "_u"), "user_id", "left")
              .join(model.item_factors.withColumnRenamed("vec", "_v"), "product_id", "left"))
    rating = F.lit(model.global_mean) + _dot(F.col("_u"), F.col("_v"))
    pred = F.when(F.col("_u").isNotNull() & F.col("_v").isNotNull(),
                  F.least(F.greatest(rating, F.lit(1.0)), F.lit(5.0))).otherwise(F.lit(model.global_mean))
    return p.select("user_id", "product_id", pred.alias("prediction"))


def recommend_cf(model: SVDModel, users: DataFrame, n: int = S.TOP_K, exclude_known: bool = False,
                 train: DataFrame | None = None) -> DataFrame:
    """M6: top-n items by predicted rating for each known user of ``users``.

    ``exclude_known=False`` is the default behaviour of the modelled pipeline,
    whose flag has no effect; ``True`` removes the user's training items and
    needs ``train``.
    """
    if exclude_known and train is None:
        raise ValueError("exclude_known needs the training pairs")
    q = model.user_factors.join(users.select("user_id").distinct(), "user_id", "left_semi")
    seen = train.select(F.col("user_id").alias("qid"), F.col("product_id").alias("item")) if exclude_known else None
    recs = top_n_dot(q.select(F.col("user_id").alias("qid"), "vec"),
                     model.item_factors.select(F.col("product_id").alias("item"), "vec"), n,
                     mean=model.global_mean, seen=seen, drop_seen=True)
    return recs.select(F.col("qid").alias("user_id"), "rank", F.col("item").alias("product_id"), "score")


# ---------------------------------------------------------------------------
# M7–M11 content-based
# ---------------------------------------------------------------------------

def cb_feature_select(item_features: DataFrame) -> list[str]:
    """M7: numeric non-boolean columns whose name contains neither 'id'
    (any case) nor '_encoded'; all numeric columns if none remain."""
    numeric = S.numeric_columns(item_features.schema)
    picked = [c for c in numeric if "id" not in c.lower() and "_encoded" not in c]
    return picked or numeric


def cb_vectorise(item_features: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """M8: (product_id, vec) with nulls -> 0 and each column min-max scaled
    to [0, 1]; a constant column scales to 0.  All minima/maxima come from
    one aggregate over the written numbers."""
    cols = cols or cb_feature_select(item_features)
    filled = item_features.select("product_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                                  for c in cols])
    filled = materialised(filled, "item-numbers")  # read twice below
    # fitting the scaler: one aggregate (partial per partition, one row out);
    # the 2·d bounds are then literals of the projection
    st = filled.agg(*[F.min(c).alias(f"lo_{i}") for i, c in enumerate(cols)],
                    *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(cols)]).first()
    comps = []
    for i, c in enumerate(cols):
        lo, hi = st[f"lo_{i}"], st[f"hi_{i}"]
        if lo is None or hi is None or hi == lo:
            comps.append(F.lit(0.0))
        else:
            comps.append((F.col(c) - F.lit(lo)) / F.lit(hi - lo))
    return filled.select("product_id", F.array(*comps).alias("vec"))


def unit_vectors(vecs: DataFrame) -> DataFrame:
    """M9 building block: v / ||v||, zero vectors stay zero (cosine 0)."""
    norm = F.sqrt(F.aggregate(F.transform("vec", lambda x: x * x), F.lit(0.0), lambda a, x: a + x))
    return vecs.select("product_id", F.when(norm > 0, F.transform("vec", lambda x: x / norm))
                       .otherwise(F.transform("vec", lambda x: x * 0.0)).alias("vec"))


def similar_items(unit: DataFrame, items: DataFrame | None = None, n: int = S.TOP_K) -> DataFrame:
    """N most cosine-similar other items for each item of ``items``."""
    unit = materialised(unit, "unit-vectors")
    q = unit if items is None else unit.join(items.select("product_id"), "product_id", "left_semi")
    recs = top_n_dot(q.select(F.col("product_id").alias("qid"), "vec"),
                     unit.select(F.col("product_id").alias("item"), "vec"), n, exclude_self=True, nearby=True)
    return recs.select(F.col("qid").alias("product_id"), "rank", F.col("item").alias("similar_product_id"),
                       F.col("score").alias("similarity"))


def user_profiles(history: DataFrame, unit: DataFrame, dim: int) -> DataFrame:
    """Σ of unit vectors of each user's history items (items without features
    add nothing)."""
    h = history.select("user_id", "product_id")
    prof = linalg.sum_vectors(h.join(unit, "product_id").select("user_id", "vec"), "user_id")
    return (h.select("user_id").distinct().join(prof, "user_id", "left")
             .select("user_id", F.coalesce("vec", F.array_repeat(F.lit(0.0), dim)).alias("vec")))


def recommend_cb(history: DataFrame, unit: DataFrame, n: int = S.TOP_K, dim: int | None = None) -> DataFrame:
    """score_j = Σ_{i∈history} cos(i, j); the user's items are set to −1;
    top n.  Users without history rows get nothing."""
    unit = materialised(unit, "unit-vectors")
    history = materialised(history.select("user_id", "product_id"), "history")
    if dim is None:
        first = unit.select(F.size("vec").alias("d")).first()
        dim = int(first["d"]) if first else 0
    profiles = materialised(user_profiles(history, unit, dim), "profiles")
    recs = top_n_dot(profiles.select(F.col("user_id").alias("qid"), "vec"),
                     unit.select(F.col("product_id").alias("item"), "vec"), n,
                     seen=history.select(F.col("user_id").alias("qid"), F.col("product_id").alias("item")))
    return recs.select(F.col("qid").alias("user_id"), "rank", F.col("item").alias("product_id"), "score")


def holdout_history(all_pairs: DataFrame, test: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Each user's pairs minus that user's held-out items (anti join)."""
    h = all_pairs.select("user_id", "product_id")
    if users is not None:
        h = h.join(users.select("user_id"), "user_id", "left_semi")
    return h.join(test.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")


# ---------------------------------------------------------------------------
# M21 model tables
# ---------------------------------------------------------------------------

METADATA = ("model string, algorithm string, n_factors int, n_users long, n_items long, global_mean double,"
            " test_size double, random_state int, top_k int, run_id string, trained_at timestamp_ntz,"
            " precision_at_k double, recall_at_k double, ndcg_at_k double, rmse double")


def model_tables(model: SVDModel, unit: DataFrame, metrics: DataFrame | None = None, run_id: str | None = None,
                 trained_at: _dt.datetime | None = None) -> dict[str, DataFrame]:
    """The fitted models as tables: factors, singular values, item vectors,
    and one metadata row per model with run id, time and its metrics."""
    spark = unit.sparkSession
    trained_at = trained_at or _dt.datetime.now().replace(microsecond=0)
    run_id = run_id or trained_at.strftime("run_%Y%m%d_%H%M%S")
    got = {r["model"]: r.asDict() for r in metrics.collect()} if metrics is not None else {}  # one row per model
    figures = lambda m: tuple(got.get(m, {}).get(k) for k in ("precision_at_k", "recall_at_k", "ndcg_at_k", "rmse"))
    settings = (S.TEST_SIZE, S.RANDOM_STATE, S.TOP_K, run_id, trained_at)
    meta = spark.createDataFrame([
        ("collaborative_filtering", "SVD (Truncated)", model.n_factors, model.n_users, model.n_items, model.global_mean,
         *settings, *figures("collaborative_filtering")),
        ("content_based", "Cosine Similarity", None, None, unit.count(), None, *settings, *figures("content_based"))],
        METADATA)
    sigma = spark.createDataFrame([(i + 1, float(x)) for i, x in enumerate(model.sigma)], "factor int, sigma double")
    out = {"cf_user_factors": model.user_factors, "cf_item_factors": model.item_factors, "cf_sigma": sigma,
           "cb_item_vectors": unit, "model_metadata": meta}
    if metrics is not None:
        out["metrics"] = metrics
    return out
