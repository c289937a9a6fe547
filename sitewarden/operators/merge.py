"""Set-based merges: each returns the new state of a table, nothing is written row by row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """The row of each key that came last; map-side combined, so a hot key is no hot task.

    Without `order` no row of a repeated key can be the last: that is an error when the plan runs.
    """
    if order is None:
        rest = [c for c in df.columns if c not in keys]
        one = df.groupBy(*keys).agg(F.first(F.struct(F.lit(0).alias("_any"), *rest)).alias("_row"), F.count(F.lit(1)).alias("_n"))
        message = F.concat(F.lit("repeated key without an order: "), F.to_json(F.struct(*keys)))
        checked = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(message))
        return one.withColumn("_row", checked).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    rest = [c for c in df.columns if c not in keys and c != order]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def merge_latest(
    current: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    order: str | None = None,
    defaults: dict[str, Column] | None = None,
    insert_only: dict[str, Column] | None = None,
) -> DataFrame:
    """Upsert: matching rows take `update_cols` from `new`, other new rows are inserted.

    Columns outside `update_cols` keep their stored value on a match. `order` says which copy wins
    when `new` repeats a key. `defaults` are values every touched row gets, `insert_only` values of
    inserted rows only.
    """
    incoming = last_per_key(new, keys, order)
    updates = [c for c in (update_cols or incoming.columns) if c not in keys]
    n = incoming.select(*[F.col(c).alias(f"_n_{c}") for c in incoming.columns], F.lit(True).alias("_new"))
    c = current.withColumn("_cur", F.lit(True))
    condition = [F.col(k) == F.col(f"_n_{k}") for k in keys]
    joined = c.join(n, condition, "full_outer")
    is_new, is_cur = F.coalesce("_new", F.lit(False)), F.coalesce("_cur", F.lit(False))

    def value(name: str) -> Column:
        have = f"_n_{name}" in n.columns
        if name in keys:
            return F.coalesce(F.col(name), F.col(f"_n_{name}"))
        if defaults and name in defaults:
            return F.when(is_new, defaults[name]).otherwise(F.col(name))
        if name in updates and have:
            return F.when(is_new, F.col(f"_n_{name}")).otherwise(F.col(name))
        inserted = F.col(f"_n_{name}") if have else F.lit(None)
        if insert_only and name in insert_only:
            inserted = insert_only[name]
        return F.when(is_cur, F.col(name)).otherwise(inserted)

    return joined.select(*[value(name).cast(current.schema[name].dataType).alias(name) for name in current.columns])


def update_matched(current: DataFrame, updates: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Matching rows take `cols` from `updates`; unmatched rows stay; missing columns are added.

    Keys that `updates` repeats are an error when the plan runs.
    """
    once = last_per_key(updates.select(*keys, *[c for c in cols if c not in keys]), keys, None)
    u = once.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_hit"))
    joined = current.join(u, list(keys), "left")

    def value(name: str) -> Column:
        stored = F.col(name) if name in current.columns else F.lit(None)
        return F.when(F.col("_hit"), F.col(f"_u_{name}")).otherwise(stored).alias(name)

    kept = [c for c in current.columns if c not in cols]
    order = [*current.columns, *[c for c in cols if c not in current.columns]]
    return joined.select(*kept, *[value(c) for c in cols]).select(*order)
