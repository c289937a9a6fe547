"""Token counts as rollups that are maintained by deltas.

A batch of changes inserts, deletes or revises the token counts of documents. Each change is a signed difference, the differences of a batch are
summed by source, language and tokenizer version, and the sums are one committed folder. Totals are the sums over all committed batches, so they are
additive and no document is ever read again.

A batch id is committed once: its folder counts only when Spark's committer has put its `_SUCCESS` mark there, a retry of an uncommitted batch
overwrites the remains, and a retry of a committed one changes nothing. `compact` folds committed batches into one base and lists their ids
in it, so that they stay committed and are not counted twice.

Cases: null source, lang or tokenizer are keys of their own; null counts are 0; unknown or null kinds of change raise; equal rows in a batch count
as often as they come; a batch without rows commits; keys whose documents and tokens are both 0 are left out of totals; other columns
are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, docs bigint, tokens bigint"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _folders(spark: SparkSession, root: str, kind: str) -> list[str]:
    """Names of the committed folders `kind`=..., in order."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(n for n in names if n.startswith(f"{kind}=") and _exists(spark, f"{root}/{n}/_SUCCESS"))


def differences(changes: DataFrame) -> DataFrame:
    """(source, lang, tokenizer, docs, tokens) of each change, signed.

    `changes` has kind (insert, delete or revise), the keys, `tokens`, and `old_tokens` for revisions.
    """
    kind = F.col("kind")
    new, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    bad = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null"))))
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(bad.cast("int"))
    tokens = F.when(kind == "insert", new).when(kind == "delete", -new).otherwise(new - old)
    return changes.select(*KEYS, docs.cast("bigint").alias("docs"), tokens.cast("bigint").alias("tokens"))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class Rollup:
    """The totals kept under one folder of a shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def base(self) -> tuple[str | None, set[str]]:
        """The newest base and the batches it contains."""
        bases = _folders(self.spark, self.root, "base")
        if not bases:
            return None, set()
        path = f"{self.root}/{bases[-1]}"
        return path, {r.batch for r in self.spark.read.schema("batch string").json(self._list_of(bases[-1])).collect()}

    def _list_of(self, base: str) -> str:
        return f"{self.root}/batches-of-{base}"

    def committed(self) -> set[str]:
        return {n.removeprefix("batch=") for n in _folders(self.spark, self.root, "batch")} | self.base()[1]

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch. False if it has been committed before."""
        if batch in self.committed():
            return False
        _summed(differences(changes)).write.mode("overwrite").parquet(f"{self.root}/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        path, inside = self.base()
        paths = [f"{self.root}/{n}" for n in _folders(self.spark, self.root, "batch") if n.removeprefix("batch=") not in inside]
        paths += [path] if path else []
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return _summed(self.spark.read.schema(SCHEMA).parquet(*paths)).where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Fold everything committed into a new base. The list of its batches is written before the base counts."""
        batches, totals = sorted(self.committed()), self.totals()
        number = len(_folders(self.spark, self.root, "base"))
        name = f"base={number:08d}"
        self.spark.createDataFrame([(b,) for b in batches], "batch string").write.mode("overwrite").json(self._list_of(name))
        totals.write.mode("overwrite").parquet(f"{self.root}/{name}")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def piece_count(text: Column) -> Column:
    """Runs of letters, runs of digits, and every other character that is not white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]"))
