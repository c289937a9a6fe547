"""Isolation Forest: trees are fitted one per group, rows are scored in Arrow batches.

The sample of a tree is the rows of smallest hash, and a node's feature and cut come from a hash of its number, so a forest depends on its
rows and its seed alone, and SQL can grow the same one. All numbers are drawn from MD5 digests. Features are rounded to DIGITS decimals, so that values
which are equal but for the order of their sums do not part.
Only about 3 x trees x sample rows are shuffled whatever the size of the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.constants import (
    FOREST_CONTAMINATION,
    FOREST_SAMPLE,
    FOREST_SEED,
    FOREST_TREES,
    SCORE_COLUMNS,
)
from sitewarden.operators.filters import feature_matrix
from sitewarden.operators.quantiles import quantiles
from sitewarden.session import stage

_NODE_SCHEMA = "tree int, node int, feature int, threshold double, path double"
DIGITS = 9
SCORE_DIGITS = 12
_DRAW_DIGITS = 13  # hexadecimal digits of a drawn number: 52 bits
_EULER = 0.5772156649015329


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n


def _uniform(*columns: Column) -> Column:
    """A number in [0, 1) from the digest of the values, joined by bars."""
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]).cast("binary"))
    return F.conv(F.substring(digest, 1, _DRAW_DIGITS), 16, 10).cast("bigint") / F.lit(float(2**52))


def _digest(*values: object) -> str:
    return md5("|".join(map(str, values)).encode(), usedforsecurity=False).hexdigest()


def _grow(rows: np.ndarray, depth_limit: int, seed: int, tree: int) -> list[tuple]:
    """Nodes of one tree as (node, feature, threshold, path); node i has the children 2i and 2i + 1, leaves have feature -1."""
    nodes: list[tuple] = []
    pending = [(1, rows, 0)]
    while pending:
        node, part, depth = pending.pop()
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) else []
        if depth >= depth_limit or not len(spread):
            nodes.append((node, -1, 0.0, depth + average_path(len(part))))
            continue
        feature = min(spread.tolist(), key=lambda f: _digest(seed, tree, node, "feature", f))
        share = int(_digest(seed, tree, node, "cut")[:_DRAW_DIGITS], 16) / 2**52
        low, high = float(part[:, feature].min()), float(part[:, feature].max())
        threshold = low + share * (high - low)
        goes_left = part[:, feature] <= threshold
        nodes.append((node, feature, threshold, 0.0))
        pending.append((2 * node, part[goes_left], depth + 1))
        pending.append((2 * node + 1, part[~goes_left], depth + 1))
    return nodes


def fit_forest(
    df: DataFrame, n: int, key: str, columns: Sequence[str], trees: int, seed: int, sample: int = FOREST_SAMPLE
) -> pd.DataFrame:
    """Node table of a forest over the n rows of `df`, at most trees x (2 x sample - 1) rows."""
    psi = min(sample, n)
    per_tree = min(1.0, 3.0 * psi / max(n, 1))
    any_tree = min(1.0, trees * per_tree)
    pool = df.select(key, *columns).where(_uniform(F.lit(seed), F.lit("any"), F.col(key)) < any_tree)
    drawn = (
        pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("u", _uniform(F.lit(seed), F.col("tree"), F.col(key)))
        .where(F.col("u") <= per_tree / any_tree)
    )
    depth_limit = math.ceil(math.log2(max(psi, 2)))
    names = list(columns)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rows = pdf.sort_values(["u", key]).head(psi)[names].to_numpy(dtype=float)
        out = pd.DataFrame(_grow(rows, depth_limit, seed, tree), columns=["node", "feature", "threshold", "path"])
        out.insert(0, "tree", tree)
        return out

    return drawn.groupBy("tree").applyInPandas(grow, _NODE_SCHEMA).toPandas()


def isolation_forest(
    df: DataFrame,
    columns: Sequence[str] = SCORE_COLUMNS,
    trees: int = FOREST_TREES,
    contamination: float = FOREST_CONTAMINATION,
    seed: int = FOREST_SEED,
    sample: int = FOREST_SAMPLE,
    key: str = "site_id",
) -> DataFrame:
    """(key, isolation_forest_score, is_anomaly); lower is more anomalous, below 0 is an anomaly."""
    features = feature_matrix(df).select(key, *[F.round(c, DIGITS).alias(c) for c in columns])
    n = features.count()
    nodes = fit_forest(features, n, key, columns, trees, seed, sample)
    psi = min(sample, n)
    forest = []
    for _, g in nodes.groupby("tree"):
        # by node number; a tree has fewer than 2 ** (depth limit + 1) of them
        by_node = g.set_index("node").reindex(range(int(g["node"].max()) + 1))
        forest.append((by_node["feature"].fillna(-1).to_numpy(dtype=np.int64), by_node["threshold"].to_numpy(), by_node["path"].to_numpy()))
    shared = df.sparkSession.sparkContext.broadcast(forest)
    norm = average_path(psi)
    names = list(columns)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[names].to_numpy(dtype=float)
            total = np.zeros(len(x))
            row = np.arange(len(x))
            for feature, threshold, path in shared.value:
                at = np.ones(len(x), dtype=np.int64)
                inner = feature[at] >= 0
                while inner.any():
                    i, node = row[inner], at[inner]
                    at[i] = 2 * node + (x[i, feature[node]] > threshold[node])
                    inner = feature[at] >= 0
                total += path[at]
            mean = total / len(shared.value)
            raw = -np.power(2.0, -mean / norm) if norm > 0 else np.full(len(x), -0.5)
            yield pd.DataFrame({key: batch[key], "raw": np.round(raw, SCORE_DIGITS)})

    kind = features.schema[key].dataType.simpleString()
    # written once: the offset and the output read the same scores
    scored = stage(features.mapInPandas(score, f"{key} {kind}, raw double"), "raw_scores")
    offset = quantiles(scored, ["raw"], (contamination,)).select(F.col("q")[0].alias("v")).scalar()
    return (
        scored.withColumn("isolation_forest_score", F.round(F.col("raw") - offset, SCORE_DIGITS))
        .select(key, "isolation_forest_score")
        .withColumn("is_anomaly", F.col("isolation_forest_score") < 0)
    )


def attach_anomalies(scores: DataFrame, forest: DataFrame, key: str = "site_id") -> DataFrame:
    """Scores with the forest's score and flag; the risk level is not touched."""
    kept = scores.drop("isolation_forest_score", "is_anomaly")
    return kept.join(forest, key, "left")
