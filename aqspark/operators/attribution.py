"""Feature attributions of a fitted model."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, functions as F

from aqspark import spec as S
from aqspark.operators.forest import ForestModel
from aqspark.sources.staging import new_path, stage

#: Nodes of trees whose leaves are sent to all tasks at a time; more trees take more passes over the rows.
CHUNK_NODES = 200_000


def linear_attribution(df: DataFrame, weights: dict[str, float], key: list[str], background: DataFrame | None = None) -> DataFrame:
    """(key, feature, attribution): ``w * (x - mean x)``, exact for a linear model."""
    source = background if background is not None else df
    means = source.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in weights]).select(F.struct("*")).scalar()
    cells = [
        F.struct(F.lit(c).alias("feature"), (F.lit(float(w)) * (F.col(c) - means[c])).alias("attribution"))
        for c, w in weights.items()
    ]
    return df.select(*key, F.explode(F.array(*cells)).alias("e")).select(*key, "e.*")


def _orders(size: int, permutations: int, seed: int) -> list[list[int]]:
    """Random orders, each followed by its reverse, which evens out the estimate."""
    rng, out = random.Random(seed), []
    while len(out) < permutations:
        order = rng.sample(range(size), size)
        out += [order, order[::-1]]
    return out[:permutations]


def sampled_attribution(
    df: DataFrame, model: Transformer, features: list[str], key: list[str], permutations: int = 4,
    background: DataFrame | None = None, prediction: str = "prediction", seed: int = S.SEED,
) -> DataFrame:
    """(key, feature, attribution): Shapley values by permutation sampling, for any fitted model.

    In each order the features of a row replace the background means one after the other; the change of the
    prediction belongs to the feature replaced. All variants are scored in one pass; each prediction counts
    for the feature before it and against the one after it, so the sum needs map-side combining only.
    """
    orders = _orders(len(features), permutations, seed)
    source = background if background is not None else df
    means = source.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features]).select(F.struct("*")).scalar()
    steps = len(features)
    # rank of each feature in each order, and the feature at each rank
    rank = F.array(*[F.array(*[F.lit(order.index(j)) for j in range(steps)]) for order in orders])
    names = F.array(*[F.array(*[F.lit(features[j]) for j in order]) for order in orders])
    variants = (
        df.select(*key, *[F.col(c).cast("double").alias(c) for c in features if c not in key])
        .withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))))
        .withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    )
    mixed = variants.select(
        *key,
        "_p",
        "_k",
        *[
            F.when(rank[F.col("_p")][j] < F.col("_k"), F.col(c).cast("double")).otherwise(means[c]).alias(c)
            for j, c in enumerate(features)
            if c not in key
        ],
    )
    scored = model.transform(mixed)
    order = names[F.col("_p")]
    signed = F.array(
        F.struct(F.get(order, F.col("_k") - 1).alias("feature"), F.col(prediction).alias("part")),
        F.struct(F.get(order, F.col("_k")).alias("feature"), (-F.col(prediction)).alias("part")),
    )
    parts = scored.select(*key, F.explode(signed).alias("e")).select(*key, "e.*").where(F.col("feature").isNotNull())
    return parts.groupBy(*key, "feature").agg((F.sum("part") / F.lit(float(len(orders)))).alias("attribution"))


def attribution(
    df: DataFrame, model: PipelineModel, features: list[str], key: list[str], background: DataFrame | None = None
) -> DataFrame:
    """(key, feature, attribution) by the way that is exact for the model: trees by their leaves, linear models by any order; others are sampled."""
    last = model.stages[-1]
    if hasattr(last, "treeWeights"):
        return tree_attribution(df, model, features, key, background)
    orders = 2 if isinstance(last, LinearRegressionModel) else 8
    return sampled_attribution(df, model, features, key, orders, background)


# ---- trees ---------------------------------------------------------------------------------------


def tree_attribution(
    df: DataFrame, model: PipelineModel, features: list[str], key: list[str], background: DataFrame | None = None, chunk_nodes: int = CHUNK_NODES
) -> DataFrame:
    """(key, feature, attribution): exact Shapley values against the mean row, for forests and boosted trees.

    A leaf is reached from a set of features if each condition on its path holds for the row where the feature is in the set, for the mean row where
    it is not. So the features whose conditions only the row fulfils (a of them) must be in the set, and those that only the
    mean row fulfils (b) must not: a leaf gives each of the first its value times (a - 1)! b! / (a + b)!, and takes a! (b - 1)! / (a + b)! of it from each of
    the second. A row costs leaves times depth. Leaves reach the tasks in chunks of whole trees, each of which is one pass over the rows.
    """
    spark, trees = df.sparkSession, model.stages[-1]
    source = background if background is not None else df
    mean = source.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features])
    prepare = PipelineModel(model.stages[:-1])
    z = np.array(prepare.transform(mean).select(vector_to_array("features").alias("v")).first()["v"])
    sizes, read = _stored_nodes(spark, trees)
    # a forest is the mean of its trees
    total = sum(trees.treeWeights) if "Forest" in type(trees).__name__ else 1.0
    weights = np.array(trees.treeWeights) / total
    plain = df.select(*key, *[F.col(c).cast("double").alias(c) for c in features if c not in key])
    rows = prepare.transform(plain).select(*key, vector_to_array("features").alias("v"), F.array(*[F.lit(0.0)] * len(features)).alias("parts"))
    chunks: list[list[int]] = [[]]
    held = 0
    for tree, size in sizes:
        if held and held + size > chunk_nodes:
            chunks, held = [*chunks, []], 0
        chunks[-1].append(tree)
        held += size
    for i, chunk in enumerate(chunks):
        leaves = _leaves(read(chunk), weights, z)
        rows = _add_leaves(rows, spark.sparkContext.broadcast(leaves), key)
        if 0 < i < len(chunks) - 1:
            rows = stage(rows, "parts")
    cells = F.arrays_zip(F.array(*map(F.lit, features)).alias("feature"), F.col("parts").alias("attribution"))
    return rows.select(*key, F.explode(cells).alias("e")).select(*key, "e.feature", "e.attribution")


def _stored_nodes(spark, trees) -> tuple[list[tuple[int, int]], Callable[[list[int]], np.ndarray]]:
    """(tree, number of nodes) of all trees, and a function that gives (tree, node, value, left, right, feature, threshold) of some."""
    if isinstance(trees, ForestModel):
        return list(enumerate(trees.trees.sizes)), trees.nodes
    path = new_path(spark, "trees")
    trees.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")

    def read(chunk: list[int]) -> np.ndarray:
        own = nodes.where(F.col("treeID").isin(chunk)).select("treeID", "id", "prediction", "leftChild", "rightChild", "split.featureIndex", F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"))
        return own.toPandas().to_numpy(dtype=float)

    return [(r["treeID"], r["count"]) for r in sorted(nodes.groupBy("treeID").count().collect())], read  # as many rows as trees


def _leaves(nodes: np.ndarray, weights: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per leaf: its value, and per feature on its path the feature, the bounds (low < x <= high) and whether the mean row is inside."""
    at = {(int(t), int(i)): row for t, i, *row in nodes}
    found = []
    for tree in sorted({t for t, _ in at}):
        waiting = [(0, {})]
        while waiting:
            i, bounds = waiting.pop()
            value, left, right, feature, threshold = at[tree, i]
            if left < 0:
                found.append((value * weights[tree], bounds))
                continue
            low, high = bounds.get(int(feature), (-np.inf, np.inf))
            waiting.append((int(left), {**bounds, int(feature): (low, min(high, threshold))}))
            waiting.append((int(right), {**bounds, int(feature): (max(low, threshold), high)}))
    width = max([1, *(len(b) for _, b in found)])
    feature, low, high = np.zeros((len(found), width), dtype=np.int64), np.full((len(found), width), -np.inf), np.full((len(found), width), np.inf)
    for k, (_, bounds) in enumerate(found):
        for m, (f, (a, b)) in enumerate(bounds.items()):
            feature[k, m], low[k, m], high[k, m] = f, a, b
    return np.array([v for v, _ in found]), feature, low, high, (z[feature] > low) & (z[feature] <= high)


def _add_leaves(rows: DataFrame, shared, key: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, feature, low, high, mean_in = shared.value
        size = feature.shape[1] + 1
        gain = np.array([[math.factorial(a - 1) * math.factorial(b) / math.factorial(a + b) if a else 0.0 for b in range(size)] for a in range(size)])
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            parts = batch.column("parts").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).copy()
            for k, x in enumerate(v):
                row_in = (x[feature] > low) & (x[feature] <= high)
                live = (row_in | mean_in).all(axis=1) & (row_in != mean_in).any(axis=1)
                plus, minus = row_in[live] & ~mean_in[live], mean_in[live] & ~row_in[live]
                a, b = plus.sum(axis=1), minus.sum(axis=1)
                share = value[live, None] * (plus * gain[a, b][:, None] - minus * gain[b, a][:, None])
                parts[k] += np.bincount(feature[live].ravel(), weights=share.ravel(), minlength=parts.shape[1])
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(0, parts.size + 1, parts.shape[1]), pa.int32()), pa.array(parts.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in key), batch.column("v"), arrays], names=[*key, "v", "parts"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in key)
    return rows.mapInArrow(run, f"{kinds}, v array<double>, parts array<double>")
