"""A corpus from raw documents to token files, in five stages. Each stage reads what the one before it kept.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitewarden.llm import edit_matching, language_kn, mixing, near_copies, token_store
from sitewarden.llm.common import table
from sitewarden.llm.queries import tokenizer_path
from sitewarden.session import new_path, stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected: no letters, no clear language, or unlike every learned one."""
    return language_kn.keep_identified(docs, language_kn.fit_documents(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies: five-word Jaccard similarity of at least 0.8.

    Fingerprints near each other in vantage-point trees come first, an exact filter by prefixes finds the pairs beyond their reach.
    """
    return near_copies.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item within its edit budget."""
    return edit_matching.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources come near their target weights, in shuffled order."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise, write rANS-coded files and read them back: one row per document."""
    path = new_path(spark, "token_store")
    token_store.write_store(docs, path, tokenizer_path())
    return token_store.read_store(spark, path)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_output", write_tokens),
]

# fitted models, connected components, edit distances and coded files are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
