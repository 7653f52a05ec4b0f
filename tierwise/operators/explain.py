"""Exact Shapley values of tree ensembles.

An ensemble is read as a table of leaves.  Each leaf asks for at most ``depth`` features to
lie in an interval; which of them a row satisfies is a small bit mask, and the leaf's
contribution depends on that mask alone.  Contributions per mask are worked out once, from
a bounded background or from the covers along the path, and rows then only look theirs up:
no row meets another row, and nothing is shuffled.  Values are in margin units.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwise.functions.hashing import order_hash
from tierwise.functions.lineage import shared_dir
from tierwise.functions.quantiles import exact_quantiles

LEAF_SCHEMA = (
    "tree int, leaf int, value double, cover double, "
    "path array<struct<feature:int,low:double,high:double,ratio:double>>"
)


#: Contributions by mask that a worker may hold for all leaves together.
TABLE_BYTES = 64 << 20
#: Rows that are worked out without masks, and numbers held for them meanwhile.
FEW_ROWS, CELLS = 256, 1 << 18


@dataclass
class Leaf:
    """A leaf: its weighted value and, per feature on its path, interval and cover ratio."""

    value: float
    features: list[int]
    low: np.ndarray
    high: np.ndarray
    ratio: np.ndarray

    def masks(self, x: np.ndarray) -> np.ndarray:
        """Bit j is set where the row's value for the j-th path feature is in (low, high]."""
        out = np.zeros(len(x), dtype=np.int64)
        for j, f in enumerate(self.features):
            out |= ((x[:, f] > self.low[j]) & (x[:, f] <= self.high[j])).astype(np.int64) << j
        return out


# ---------------------------------------------------------------- leaves of a model


def leaf_table(spark: SparkSession, model) -> DataFrame:
    """The leaves of a fitted boosted model, from its stored nodes.

    The number of leaves is set by the settings of the model, not by the data.
    """
    path = f"{shared_dir(spark).rstrip('/')}/nodes-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict] = {}
    for n in nodes:
        trees.setdefault(n["treeID"], {})[n["id"]] = n
    leaves = []
    for tree, by_id in sorted(trees.items()):
        weight = float(model.treeWeights[tree])
        stack = [(0, {})]
        while stack:
            at, path_so_far = stack.pop()
            node = by_id[at]
            if node["leftChild"] < 0:
                parts = [(f, *interval) for f, interval in sorted(path_so_far.items())]
                leaves.append((tree, at, weight * node["prediction"], _cover(node), parts))
                continue
            split = node["split"]
            if split["numCategories"] >= 0:
                raise ValueError("categorical splits are not supported; encode categories as plain numbers")
            f, cut = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
            low, high, ratio = path_so_far.get(f, (-math.inf, math.inf, 1.0))
            for child, interval in (
                (node["leftChild"], (low, min(high, cut))),
                (node["rightChild"], (max(low, cut), high)),
            ):
                share = _cover(by_id[child]) / _cover(node)
                stack.append((child, {**path_so_far, f: (*interval, ratio * share)}))
    return spark.createDataFrame(leaves, LEAF_SCHEMA)


def _cover(node) -> float:
    """Weighted number of training rows in a node."""
    return float(node["impurityStats"][0])


def read_leaves(table: DataFrame) -> list[Leaf]:
    """Leaves as arrays for the kernels; as many as the model has."""
    out = []
    for r in table.orderBy("tree", "leaf").collect():
        parts = r["path"]
        out.append(
            Leaf(
                r["value"],
                [p["feature"] for p in parts],
                np.array([p["low"] for p in parts], dtype=float),
                np.array([p["high"] for p in parts], dtype=float),
                np.array([p["ratio"] for p in parts], dtype=float),
            )
        )
    return out


# ---------------------------------------------------------------- contributions per mask


def _bits(masks: np.ndarray, d: int) -> np.ndarray:
    return (masks[:, None] >> np.arange(d)) & 1


def interventional_for(leaf: Leaf, masks: np.ndarray, seen: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Contribution of every feature for given row masks, averaged over background masks."""
    d = len(leaf.features)
    out = np.zeros((len(masks), d))
    if not d or not len(seen):
        return out
    x, z = _bits(masks, d)[:, None, :], _bits(seen, d)[None, :, :]
    reachable = ((x | z) == 1).all(axis=2)
    only_x, only_z = (x & ~z) & 1, (z & ~x) & 1
    a, b = only_x.sum(axis=2), only_z.sum(axis=2)
    fact = np.array([math.factorial(i) for i in range(d + 1)], dtype=float)
    whole = fact[a + b]
    gain = np.where(a > 0, fact[np.maximum(a - 1, 0)] * fact[b] / whole, 0.0)
    loss = np.where(b > 0, fact[a] * fact[np.maximum(b - 1, 0)] / whole, 0.0)
    weight = np.where(reachable, share[None, :], 0.0)
    out += np.einsum("xz,xzd->xd", gain * weight, only_x)
    out -= np.einsum("xz,xzd->xd", loss * weight, only_z)
    return leaf.value * out


def interventional_weights(leaf: Leaf, background: np.ndarray) -> np.ndarray:
    """Contribution of every feature for every row mask, averaged over the background."""
    seen, counts = np.unique(leaf.masks(background), return_counts=True) if len(background) else (np.zeros(0, int),) * 2
    return interventional_for(leaf, np.arange(2 ** len(leaf.features)), seen, counts / max(1, len(background)))


def _path_gains(one: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf of value 1: ``one`` is 1 where a feature (last axis) is inside, and
    ``zero`` the cover ratios.

    With every other feature kept with chance t, the gain of a feature is a polynomial in t of
    degree d-1, and its Shapley value the integral from 0 to 1, which Gauss points sum exactly.
    """
    points, weights = np.polynomial.legendre.leggauss((one.shape[-1] + 1) // 2)
    total = np.zeros(np.broadcast_shapes(one.shape, zero.shape))
    for t, weight in zip((points + 1) / 2, weights / 2):
        factors = zero * (1 - t) + one * t
        # The product over all others, from both ends, as a factor may be 0.
        before, after = np.ones_like(factors), np.ones_like(factors)
        np.cumprod(factors[..., :-1], axis=-1, out=before[..., 1:])
        np.cumprod(factors[..., :0:-1], axis=-1, out=after[..., -2::-1])
        total += weight * before * after
    return (one - zero) * total


def path_for(leaf: Leaf, masks: np.ndarray) -> np.ndarray:
    """The same from cover ratios: a feature left out is averaged by the training covers."""
    d = len(leaf.features)
    return leaf.value * _path_gains(_bits(masks, d).astype(float), leaf.ratio) if d else np.zeros((len(masks), 0))


def path_weights(leaf: Leaf) -> np.ndarray:
    """Contributions along the path for every row mask."""
    return path_for(leaf, np.arange(2 ** len(leaf.features)))


@dataclass
class PackedLeaves:
    """Leaves as a few flat arrays, so that an ensemble of any size is sent and held compactly."""

    values: np.ndarray
    first: np.ndarray
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    ratio: np.ndarray

    @classmethod
    def of(cls, leaves: Sequence[Leaf]) -> PackedLeaves:
        flat = lambda name, kind: np.concatenate([np.zeros(0, kind), *[np.asarray(getattr(leaf, name), kind) for leaf in leaves]])
        first = np.cumsum([0, *[len(leaf.features) for leaf in leaves]])
        values = np.array([leaf.value for leaf in leaves], dtype=float)
        return cls(values, first, flat("features", np.int32), flat("low", float), flat("high", float), flat("ratio", float))

    def __len__(self) -> int:
        return len(self.values)

    def __iter__(self) -> Iterator[Leaf]:
        for i, value in enumerate(self.values.tolist()):
            at = slice(self.first[i], self.first[i + 1])
            yield Leaf(value, self.features[at].tolist(), self.low[at], self.high[at], self.ratio[at])

    def table_bytes(self) -> int:
        """Of a table for every leaf and mask."""
        d = np.diff(self.first).astype(float)
        return int((8 * d * 2.0**d).sum())


def _leaf_sums(leaves: Sequence[Leaf], tables: Sequence[np.ndarray], x: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    for leaf, table in zip(leaves, tables):
        if leaf.features:
            out[:, leaf.features] += table[leaf.masks(x)]
    return out


def leaf_sums_without_tables(leaves: PackedLeaves, x: np.ndarray, background: np.ndarray | None = None) -> np.ndarray:
    """Contributions worked out for the masks that the rows have, one leaf at a time, or for the
    rows themselves where they are fewer than masks, many leaves at a time."""
    out = np.zeros_like(x)
    if background is None and len(x) <= FEW_ROWS:
        depth = np.diff(leaves.first)
        for d in np.unique(depth[depth > 0]).tolist():
            alike = np.flatnonzero(depth == d)
            for part in np.array_split(alike, -(-len(alike) * len(x) * d // CELLS) or 1):
                at = leaves.first[part][:, None] + np.arange(d)
                features = leaves.features[at]
                own = x[:, features]
                inside = ((own > leaves.low[at]) & (own <= leaves.high[at])).astype(float)
                found = _path_gains(inside, leaves.ratio[at][None]) * leaves.values[part][None, :, None]
                for j in range(d):
                    np.add.at(out.T, features[:, j], found[:, :, j].T)
        return out
    for leaf in leaves:
        if not leaf.features or not len(x):
            continue
        masks, back = np.unique(leaf.masks(x), return_inverse=True)
        if background is None:
            found = path_for(leaf, masks)
        else:
            seen, counts = np.unique(leaf.masks(background), return_counts=True)
            found = np.concatenate(
                [interventional_for(leaf, part, seen, counts / len(background)) for part in np.array_split(masks, -(-len(masks) // 256))]
            )
        out[:, leaf.features] += found[back]
    return out


def margin(leaves: Sequence[Leaf], x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x))
    for leaf in leaves:
        out += leaf.value * (leaf.masks(x) == 2 ** len(leaf.features) - 1)
    return out


def interventional_base(leaves: Sequence[Leaf], background: np.ndarray) -> float:
    return float(margin(leaves, background).mean()) if len(background) else 0.0


def path_base(leaves: Sequence[Leaf]) -> float:
    return float(sum(leaf.value * np.prod(leaf.ratio) for leaf in leaves))


# ---------------------------------------------------------------- over DataFrames


def shap_values(x: Column, leaves: Sequence[Leaf], background: np.ndarray | None = None) -> Column:
    """Shapley values of a feature array: against a background, or along the paths without one.

    A worker holds the contributions of all masks of all leaves while they take up to
    ``TABLE_BYTES``.  For a larger ensemble it works out those of the masks at hand, leaf by leaf, so
    that it holds little more than the packed leaves.
    """
    packed = PackedLeaves.of(list(leaves))
    if background is not None and not len(background):
        packed = PackedLeaves.of([])
    held = packed.table_bytes() <= TABLE_BYTES

    @F.pandas_udf("array<double>")
    def explain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = None
        if held and background is None:
            tables = [path_weights(leaf) for leaf in packed]
        elif held:
            tables = [interventional_weights(leaf, background) for leaf in packed]
        for batch in batches:
            if len(batch):
                rows = np.stack(batch.to_numpy()).astype(float)
                if held:
                    values = _leaf_sums(packed, tables, rows)
                else:
                    values = leaf_sums_without_tables(packed, rows, background)
                yield pd.Series(list(values), index=batch.index)
            else:
                yield pd.Series([], dtype=object)

    return explain(x)


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The n rows that come first in a seeded hash order; each task keeps n at most."""
    hashed = rows.withColumn("_hash", order_hash(F.col(key), seed))
    return hashed.orderBy("_hash", key).limit(n).drop("_hash")


def background_matrix(rows: DataFrame, key: str, x: str, n: int = 300, seed: int = 42) -> np.ndarray:
    """At most n feature rows to compare against."""
    sample = seeded_sample(rows.select(key, x), key, n, seed).select(x).toPandas()[x]
    return np.stack(sample.to_numpy()).astype(float) if len(sample) else np.zeros((0, 0))


def shap_long(explained: DataFrame, names: Sequence[str], key: str = "key", x: str = "x") -> DataFrame:
    """One row per explained row and feature, from arrays ``x`` and ``shap``."""
    cells = F.arrays_zip(
        F.array(*[F.lit(n) for n in names]).alias("feature"),
        F.col(x).alias("feature_value"),
        F.col("shap").alias("shap_value"),
    )
    return explained.select(key, F.explode(cells).alias("_c")).select(
        key, "_c.feature", "_c.feature_value", "_c.shap_value"
    )


def shap_importance(long: DataFrame) -> DataFrame:
    """Mean absolute value per feature, most important first."""
    return (
        long.groupBy("feature")
        .agg(
            F.avg(F.abs("shap_value")).alias("mean_abs_shap"),
            F.min("shap_value").alias("min_shap"),
            F.max("shap_value").alias("max_shap"),
        )
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )


def shap_distribution(
    explained: DataFrame, names: Sequence[str], probs: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95), x: str = "x", shap: str = "shap"
) -> DataFrame:
    """The spread of each feature's values, most important first: what a plot of all values shows.

    ``feature, n, mean_abs_shap, mean_shap``, a quantile for each of ``probs`` (``q05`` and so on)
    and ``direction``, the correlation of the feature with its contributions (null if either is
    constant).  Quantiles are exact; all features share each look at the rows.
    """
    wide = explained.select(
        *[F.get(shap, F.lit(i)).alias(f"s{i}") for i in range(len(names))],
        *[F.get(x, F.lit(i)).cast("double").alias(f"x{i}") for i in range(len(names))],
    )
    cuts = exact_quantiles(wide, [f"s{i}" for i in range(len(names))], list(probs))
    stats = [
        F.struct(
            F.lit(name).alias("feature"),
            F.count(f"s{i}").alias("n"),
            F.avg(F.abs(f"s{i}")).alias("mean_abs_shap"),
            F.avg(f"s{i}").alias("mean_shap"),
            *[F.lit(q).cast("double").alias(f"q{round(100 * prob):02d}") for prob, q in zip(probs, cuts[f"s{i}"])],
            (F.covar_pop(f"x{i}", f"s{i}") / F.nullif(F.stddev_pop(f"x{i}") * F.stddev_pop(f"s{i}"), F.lit(0.0))).alias("direction"),
        )
        for i, name in enumerate(names)
    ]
    # One row a feature.
    return wide.agg(F.array(*stats).alias("_f")).select(F.inline("_f")).orderBy(F.desc("mean_abs_shap"), "feature")


def top_contributions(names: Sequence[str], x: Column, shap: Column, k: int = 5) -> Column:
    """The k features of largest absolute value, ordered inside the row itself."""
    cells = F.zip_with(
        F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), x.alias("value")),
        shap,
        lambda a, s: F.struct(
            (-F.abs(s)).alias("order"),
            a["feature"].alias("feature"),
            a["value"].alias("feature_value"),
            s.alias("shap_value"),
        ),
    )
    best = F.slice(F.array_sort(cells), 1, k)
    return F.transform(
        best,
        lambda c: F.struct(
            c["feature"].alias("feature"),
            c["feature_value"].alias("feature_value"),
            c["shap_value"].alias("shap_value"),
        ),
    )


def most_at_risk(explained: DataFrame, names: Sequence[str], k: int = 10, key: str = "key") -> DataFrame:
    """Top contributions of the row with the highest ``p`` (smallest key among equals)."""
    top = explained.orderBy(F.desc("p"), key).limit(1)
    best = top_contributions(names, F.col("x"), F.col("shap"), k)
    return top.select(key, "p", F.posexplode(best).alias("_at", "_c")).select(
        key, "p", (F.col("_at") + 1).alias("rank"), "_c.feature", "_c.feature_value", "_c.shap_value"
    )
