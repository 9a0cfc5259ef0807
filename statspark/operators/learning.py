"""Ridge models on wide features: median imputation, standardised least squares in closed form, batch scoring.

Two kinds of sums over training rows, which can be kept by day and added up, tell all that a model needs: how often each
feature has each value (for exact medians), and products of all pairs of columns (Gram matrices, for means, spreads and
the solution). What is missing is counted apart in the products, so they do not depend on the medians.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statspark.sources.tables import checkpoint_folder


@dataclass
class Ridge:
    coefficients: list[float]
    intercept: float


@dataclass
class Model:
    medians: dict[str, float]
    fitted: Ridge
    metadata: dict

    @property
    def columns(self) -> list[str]:
        return self.metadata["feature_columns"]

    def save(self, path: str) -> None:
        """A table of the features with their medians and coefficients, and one row of intercept and metadata."""
        spark = SparkSession.active()
        features = [(i, c, self.medians[c], w) for i, (c, w) in enumerate(zip(self.columns, self.fitted.coefficients, strict=True))]
        rows = spark.createDataFrame(features, "place int, feature string, median double, coefficient double")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        about = [(self.fitted.intercept, json.dumps(self.metadata))]
        spark.createDataFrame(about, "intercept double, metadata string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, path: str) -> Model:
        """Raises if there is no model at the path."""
        spark = SparkSession.active()
        about = spark.read.parquet(f"{path}/about").first()
        features = sorted(spark.read.parquet(f"{path}/features").collect(), key=lambda r: r["place"])
        fitted = Ridge([r["coefficient"] for r in features], about["intercept"])
        return cls({r["feature"]: r["median"] for r in features}, fitted, json.loads(about["metadata"]))


def _counted(columns: list[str], keyed: bool) -> Callable:
    """Of batches (key if ``keyed``, columns...): how often each value stands in the batch, by key and column."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not len(batch):
                continue
            code = np.zeros(len(batch), int)
            if keyed:
                keys = batch.column(0).dictionary_encode()
                code = keys.indices.fill_null(len(keys.dictionary)).to_numpy(zero_copy_only=False)
            out = []
            for name, column in zip(columns, batch.columns[keyed:], strict=True):
                there = column.is_valid().to_numpy(zero_copy_only=False)
                value, own = column.drop_null().to_numpy(zero_copy_only=False), code[there]
                order = np.lexsort((value, own)) if keyed else np.argsort(value)
                value, own = value[order], own[order]
                first = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (own[1:] != own[:-1])][: len(value)])
                key = [batch.column(0).take(pa.array(np.flatnonzero(there)[order][first]))] if keyed else []
                feature = pa.array([name] * len(first), pa.string())
                out.append([*key, feature, pa.array(value[first], pa.float64()), pa.array(np.diff(np.r_[first, len(value)]), pa.int64())])
            joined = [pa.concat_arrays(parts) for parts in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(joined, [*["key"] * keyed, "feature", "value", "n"])

    return run


def value_counts(rows: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """by, feature, value, n: how often each feature has each value; nulls are left out.

    The tasks count a batch at a time, so that Spark adds up a batch's different values and not its rows.
    """
    key = [] if by is None else [F.col(by).alias("key")]
    given = rows.select(*key, *(F.col(c).cast("double").alias(c) for c in columns))
    kind = "" if by is None else f"key {given.schema['key'].dataType.simpleString()}, "
    parts = given.mapInArrow(_counted(columns, by is not None), f"{kind}feature string, value double, n long")
    return parts.groupBy(*(() if by is None else (F.col("key").alias(by),)), "feature", "value").agg(F.sum("n").alias("n"))


def medians_of(counts: DataFrame) -> DataFrame:
    """feature, median of (feature, value, n): exact, of an even number the mean of the middle two.

    Values are ordered over range partitions; each partition's sums, and sums of those before it, give every value its ranks,
    and the values at the middle ranks are picked. No task holds a whole feature.
    """
    checkpoint_folder(counts.sparkSession)
    ranged = counts.repartitionByRange("feature", "value").withColumn("part", F.spark_partition_id()).checkpoint()
    sums = ranged.groupBy("feature", "part").agg(F.sum("n").alias("own"))
    of = Window.partitionBy("feature")
    earlier = of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("feature", "part", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("start"), F.sum("own").over(of).alias("all"))
    inside = Window.partitionBy("part", "feature").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranks = ranged.join(starts, ["part", "feature"]).withColumn("upto", F.col("start") + F.sum("n").over(inside))
    holds = lambda rank: (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
    low, high = F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2)
    middle = ranks.groupBy("feature").agg(F.max(F.when(holds(low), F.col("value"))).alias("low"), F.max(F.when(holds(high), F.col("value"))).alias("high"))
    return middle.select("feature", ((F.col("low") + F.col("high")) / 2).alias("median"))


def medians(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row: each feature's exact, interpolated median; 0 for a feature without values."""
    found = medians_of(value_counts(rows, columns))
    return found.agg(*(F.coalesce(F.max(F.when(F.col("feature") == c, F.col("median"))), F.lit(0.0)).alias(c) for c in columns))


def feature_statistics(rows: DataFrame, columns: list[str]) -> DataFrame:
    """feature, median, mean, std (population) over the imputed feature: all from how often each value occurs, in one pass."""
    checkpoint_folder(rows.sparkSession)
    counts = value_counts(rows.withColumn("_all", F.lit(1)), [*columns, "_all"]).checkpoint()
    n_rows = counts.where("feature = '_all'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known = counts.where("feature <> '_all'")
    middle = {r["feature"]: r["median"] for r in medians_of(known).collect()}
    of = F.create_map(*(F.lit(x) for c in columns for x in (c, float(middle.get(c, 0.0)))))
    names = rows.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    found = known.groupBy("feature").agg(F.sum("n").alias("some"))
    none = names.join(found, "feature", "left").select("feature", F.try_element_at(of, "feature").alias("value"), (F.lit(n_rows) - F.coalesce("some", F.lit(0))).alias("n"))
    every = known.unionByName(none).where("n > 0")
    mean = every.groupBy("feature").agg((F.sum(F.col("value") * F.col("n")) / F.lit(n_rows)).alias("mean"))
    apart = (F.col("value") - F.col("mean")) ** 2 * F.col("n")
    spread = every.join(mean, "feature").groupBy("feature").agg(F.first("mean").alias("mean"), F.sqrt(F.sum(apart) / F.lit(n_rows)).alias("std"))
    return names.join(spread, "feature", "left").select("feature", F.try_element_at(of, "feature").alias("median"), "mean", "std")


#: Days whose matrices a task holds at once.
DAYS = 256


def _products(columns: list[str]) -> Callable:
    """Of batches (day, label, columns...): for each day and row number the sums of that row of the Gram matrix."""
    size = 2 * len(columns) + 2

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = {}

        def out():
            days, grams = list(held), np.concatenate(list(held.values()))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, grams.size + 1, size), pa.int32()), pa.array(grams.ravel()))
            result = [pa.array(np.repeat(np.array(days, "datetime64[D]"), size), pa.date32()), pa.array(np.tile(np.arange(size), len(days)), pa.int32()), flat]
            held.clear()
            return pa.RecordBatch.from_arrays(result, ["day", "place", "sums"])

        for batch in batches:
            if not len(batch):
                continue
            day = batch.column(0).to_numpy(zero_copy_only=False).astype("datetime64[D]")
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[2:]])
            none = np.isnan(x)
            row = np.column_stack([np.where(none, 0.0, x), none, np.ones(len(x)), label])
            for d in np.unique(day):
                own = row[day == d]
                held[d] = held.get(d, 0) + own.T @ own
            if len(held) > DAYS:
                yield out()
        if held:
            yield out()

    return run


def grams(rows: DataFrame, columns: list[str], day: Column | str = "game_date") -> DataFrame:
    """day, place, sums: a day's Gram matrix by rows, over [values with 0 for null, 1 for null, 1, label]; rows without label
    are left out. Products are made in the tasks (one matrix product a day and batch) and added by Spark."""
    given = rows.where("label is not null").select(
        (F.col(day) if isinstance(day, str) else day).cast("date").alias("day"),
        F.col("label").cast("double").alias("label"),
        *(F.col(c).cast("double").alias(c) for c in columns),
    )
    return _added(given.mapInArrow(_products(columns), "day date, place int, sums array<double>"), columns, "day", "place")


def _added(parts: DataFrame, columns: list[str], *by: str) -> DataFrame:
    size = 2 * len(columns) + 2
    return parts.groupBy(*by).agg(F.array(*(F.sum(F.col("sums")[i]) for i in range(size))).alias("sums"))


def solve(
    gram: np.ndarray, middle: np.ndarray, alpha: float = 1.0, fit_intercept: bool = True
) -> tuple[Ridge, float, int]:
    """Ridge regression on standardised, median-imputed features from a Gram matrix: model, training RMSE, rows."""
    p = len(middle)
    fill = np.zeros((p + 2, 2 * p + 2))
    fill[:p, :p], fill[:p, p : 2 * p] = np.eye(p), np.diag(middle)
    fill[p, 2 * p] = fill[p + 1, 2 * p + 1] = 1
    full = fill @ gram @ fill.T
    n, y, yy = full[p, p], full[p, p + 1], full[p + 1, p + 1]
    mean = full[:p, p] / n
    spread = full[:p, :p] / n - np.outer(mean, mean)
    scale = np.maximum(np.diag(full)[:p] / n, 1e-300)
    flat = np.diag(spread) <= 1e-12 * scale
    std = np.sqrt(np.where(flat, 1, np.diag(spread)))
    keep = np.where(flat, 0.0, 1.0)
    z = n * spread / np.outer(std, std) * np.outer(keep, keep)
    base = y / n if fit_intercept else 0.0
    towards = (full[:p, p + 1] - mean * y) / std * keep
    w = np.linalg.solve(z + alpha * np.eye(p), towards)
    rest = yy - 2 * base * y + n * base**2 - 2 * w @ towards + w @ z @ w
    return Ridge((w / std).tolist(), float(base - w / std @ mean)), float(np.sqrt(max(rest, 0.0) / n)), round(n)


def train_from_sums(
    counts: DataFrame,
    products: DataFrame,
    columns: list[str],
    trained_at: str,
    alpha: float = 1.0,
    path: str | None = None,
    fit_intercept: bool = True,
) -> Model | dict:
    """Fit from value counts (feature, value, n) and Gram matrices (place, sums) of any number of days, and save under
    ``path``; without rows nothing is saved and only empty metadata comes back. What reaches the driver is one matrix and a
    median for each feature."""
    size = 2 * len(columns) + 2
    found = {r["place"]: r["sums"] for r in _added(products, columns, "place").collect()}
    if not found or found[size - 2][size - 2] == 0:
        return {"n_samples": 0, "trained_at": None}
    per = counts.groupBy("feature", "value").agg(F.sum("n").alias("n"))
    known = {r["feature"]: r["median"] for r in medians_of(per).collect()}
    middle = {c: known.get(c, 0.0) for c in columns}
    gram = np.array([found[i] for i in range(size)])
    fitted, error, n = solve(gram, np.array([middle[c] for c in columns]), alpha, fit_intercept)
    about = {"trained_at": trained_at, "feature_columns": columns, "train_rmse": error, "n_samples": n, "alpha": alpha, "fit_intercept": fit_intercept}
    model = Model(middle, fitted, about)
    if path is not None:
        model.save(path)
    return model


def train(
    rows: DataFrame, columns: list[str], trained_at: str, alpha: float = 1.0, path: str | None = None, fit_intercept: bool = True
) -> Model | dict:
    """The same from training rows (columns, label)."""
    labelled = rows.where("label is not null")
    products = grams(labelled, columns, F.lit("1970-01-01").cast("date"))
    return train_from_sums(value_counts(rows, columns), products, columns, trained_at, alpha, path, fit_intercept)


def score(model: Model, rows: DataFrame, out: str) -> DataFrame:
    """``rows`` with the model's prediction as ``out``; columns that the model lacks are imputed."""
    value = F.lit(model.fitted.intercept)
    for c, w in zip(model.columns, model.fitted.coefficients, strict=True):
        value = value + F.lit(w) * F.coalesce(F.col("given")[c], F.lit(model.medians[c]))
    given = F.struct(*((F.col(c) if c in rows.columns else F.lit(None)).cast("double").alias(c) for c in model.columns))
    return rows.withColumn("given", given).select(*rows.columns, value.alias(out))


def predictions(roster: DataFrame, rolling_on_day: DataFrame, as_of: str, batter: Model, pitcher: Model) -> DataFrame:
    """A row per scheduled game and player; players without features have no predictions but model versions."""
    from statspark.operators.features import wide
    from statspark.schemas import BATTER, PITCHER

    bat = score(batter, wide(rolling_on_day, BATTER), "bat").select("player_id", F.round("bat", 4).alias("pred_bat_woba"))
    pit = score(pitcher, wide(rolling_on_day, PITCHER), "pit").select("player_id", F.round("pit", 2).alias("pred_pit_fip"))
    rows = roster.join(bat, "player_id", "left").join(pit, "player_id", "left")
    return rows.select(
        "game_pk",
        "player_id",
        F.lit(as_of).cast("date").alias("as_of_date"),
        "pred_bat_woba",
        "pred_pit_fip",
        F.lit(batter.metadata["trained_at"]).alias("model_version_bat"),
        F.lit(pitcher.metadata["trained_at"]).alias("model_version_pit"),
    )


def no_predictions(roster: DataFrame) -> DataFrame:
    """The empty result of ``predictions``."""
    kinds = {"as_of_date": "date", "pred_bat_woba": "double", "pred_pit_fip": "double", "model_version_bat": "string", "model_version_pit": "string"}
    return roster.where(F.lit(False)).select("game_pk", "player_id", *(F.lit(None).cast(k).alias(c) for c, k in kinds.items()))
