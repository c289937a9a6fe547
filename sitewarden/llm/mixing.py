"""Mixing sources to target weights by Poisson replication.

A source with `available` characters and a share w of the mixture's `total` is repeated w * total / available times on average. Each document
draws its number of copies from the Poisson distribution with that mean, by inverting the distribution at a uniform number made from
its id and a seed: the same on every run and every cluster, without any exchange between documents. Copies are dealt to
partitions and ordered within them by a hash of id, copy and seed, which is a random order of the whole mixture.

Means may be large: probabilities are built in logarithms, up to the value that the mean exceeds with a chance below 1e-20.

Cases: null sources are a source of their own; a source without any character has rate 1, as its documents cannot change the weights; sources
missing from given weights have weight 0 and vanish; null and empty texts count 0 characters and are copied like others of their
source; rows that share a doc_id draw the same number; other columns are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitewarden.session import stage

ALPHA = 0.5
SEED = 17
MAX_BROADCAST_BYTES = 64_000_000
SALTS = 64
_DIGITS = 13  # hexadecimal digits of the uniform numbers: 52 bits


def hashed(*parts: Column) -> Column:
    """A whole number of 52 bits from the MD5 of the parts."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _DIGITS), 16, 10).cast("bigint")


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = ALPHA, total: int | None = None) -> DataFrame:
    """(source_key, available, rate) of every source.

    `weights` are target shares of any scale. Without them they are available ** alpha, which lifts small sources. `total` is the
    size of the mixture in characters, that of the input if not given.
    """
    sizes = docs.groupBy(source_key(F.col("source")).alias("source_key")).agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).alias("available"))
    if weights is None:
        weight = F.pow(F.col("available").cast("double"), F.lit(alpha))
    elif weights:
        rows = [("null" if k is None else f"={k}", float(v)) for k, v in weights.items()]
        given = docs.sparkSession.createDataFrame(rows, "source_key string, given double")
        sizes = sizes.join(given, "source_key", "left")
        weight = F.coalesce("given", F.lit(0.0))
    else:
        weight = F.lit(0.0)
    sizes = sizes.withColumn("weight", F.when(F.col("available") > 0, weight).otherwise(0.0))
    whole = sizes.agg(F.sum("weight").alias("weights"), F.sum("available").cast("double").alias("chars"))
    size = F.col("chars") if total is None else F.lit(float(total))
    rate = F.when(F.col("available") == 0, 1.0).when(F.col("weights") > 0, F.col("weight") * size / F.col("weights") / F.col("available")).otherwise(0.0)
    # one row on the right: a scalar, not a product of tables
    return sizes.crossJoin(F.broadcast(whole)).select("source_key", "available", rate.alias("rate"))


def with_distribution(rated: DataFrame) -> DataFrame:
    """Add `cdf`: the Poisson distribution function at 0, 1, 2 ... for each rate."""
    top = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 20).cast("int")
    steps = rated.select("source_key", "rate", F.explode(F.sequence(F.lit(0), top)).alias("k"))
    by = Window.partitionBy("source_key").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = steps.withColumn("log_factorial", F.sum(F.ln(F.greatest("k", F.lit(1)))).over(by))
    log_p = F.when(F.col("rate") > 0, F.col("k") * F.ln("rate") - F.col("rate") - F.col("log_factorial"))
    p = F.when(F.col("rate") > 0, F.exp(log_p)).otherwise(F.when(F.col("k") == 0, 1.0).otherwise(0.0))
    summed = steps.withColumn("p", p).withColumn("c", F.sum("p").over(by))
    return summed.groupBy("source_key", "rate").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda s: s["c"]).alias("cdf"))


def table_bytes(table: DataFrame) -> int:
    """Size of the distributions: 8 bytes a step, and the keys."""
    return table.agg(F.sum(8 * F.size("cdf").cast("bigint") + F.octet_length("source_key") + 64)).first()[0] or 0


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = ALPHA, total: int | None = None, seed: int = SEED) -> DataFrame:
    """(row, copy, rate, shuffle_key): each document as the struct `row`, once per copy, in shuffled order."""
    table = stage(with_distribution(rates(docs, weights, alpha, total)), "rates")
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), source_key(docs["source"]).alias("source_key"))
    keys = ["source_key"]
    if table_bytes(table) <= MAX_BROADCAST_BYTES:
        table = F.broadcast(table)
    else:
        # many sources or high rates: both sides move, a hot source's documents over SALTS keys
        keys.append("salt")
        packed = packed.withColumn("salt", F.pmod(F.xxhash64("row.doc_id"), F.lit(SALTS)).cast("int"))
        table = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    uniform = (hashed(F.lit(seed), F.col("row.doc_id")) + F.lit(0.5)) / F.lit(float(16**_DIGITS))
    drawn = (
        packed.join(table, keys)
        .withColumn("u", uniform)
        .withColumn("copies", F.expr("size(filter(cdf, c -> c < u))"))
        .where("copies > 0")
        .select("row", "rate", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    )
    keyed = drawn.withColumn("shuffle_key", hashed(F.lit(seed), F.col("row.doc_id"), F.col("copy"), F.lit("order")))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture with the documents' own columns."""
    return mix(docs, **options).select("row.*")
