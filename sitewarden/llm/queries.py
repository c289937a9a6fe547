"""The registered query of each operator, with its SQL where SQL can say it. Each takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewarden.llm import chat_parts, dual_tree, edit_matching, filter_audit, language_kn, mixing, passage_chains, quality_trees, simhash_tables, simhash_vp, token_rollup, token_store, url_graph
from sitewarden.llm.common import table
from sitewarden.session import new_path, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_url_graph")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return url_graph.judge(table(spark, folder, "pages"))


@query("op2_simhash_vp")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_vp.classes(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_ROLLUP_SQL = r"""
WITH kept AS (
  SELECT source, lang, text FROM (
    SELECT source, lang, text, doc_id, min(doc_id) OVER (PARTITION BY text) AS first_id FROM documents
  ) WHERE text IS NULL OR doc_id IS NULL OR doc_id = first_id
), counted AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM kept
  UNION ALL
  SELECT source, lang, 'pieces-1', len(regexp_extract_all(coalesce(text, ''), '\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]')) FROM kept
)
SELECT source, lang, tokenizer, count(*) AS docs, sum(n)::BIGINT AS tokens FROM counted GROUP BY 1, 2, 3
"""


@query("op3_token_rollup", _ROLLUP_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Documents arrive with estimated counts, the counts are revised, and exact copies are deleted; one batch is sent twice."""
    docs = table(spark, folder, "documents")
    text = F.col("text")
    words, pieces = token_rollup.word_count(text), token_rollup.piece_count(text)
    estimate = F.floor((F.coalesce(F.length(text), F.lit(0)) + 5) / 6)
    counts = stage(docs.select("doc_id", "source", "lang", F.md5(text.cast("binary")).alias("digest"), words.alias("words"), pieces.alias("pieces"), estimate.alias("estimate")), "counts")
    none = F.lit(None).cast("bigint")

    def changes(kind: str, rows: DataFrame, tokenizer: str, tokens: str, old: str | None = None) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), F.col(tokens).alias("tokens"), (F.col(old) if old else none).alias("old_tokens"))

    rollup = token_rollup.Rollup(spark, new_path(spark, "rollup"))
    arrivals = changes("insert", counts, "words-1", "estimate").unionByName(changes("insert", counts, "pieces-1", "pieces"))
    rollup.commit("0001-arrivals", arrivals)
    revised = changes("revise", counts, "words-1", "words", "estimate")
    rollup.commit("0002-revised", revised)
    rollup.commit("0002-revised", revised)
    rollup.compact()
    # a text with a third of all rows is spread over salts
    first = counts.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(mixing.SALTS - 1))))
    copies = counts.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(mixing.SALTS)).cast("int")).join(first, ["digest", "salt"]).where("doc_id <> first_id")
    rollup.commit("0003-copies", changes("delete", copies, "words-1", "words").unionByName(changes("delete", copies, "pieces-1", "pieces")))
    return rollup.totals()


_MIX_SQL = """
WITH sizes AS (
  SELECT coalesce('=' || source, 'null') AS source_key, sum(coalesce(length(text), 0)) AS available FROM documents GROUP BY 1
), weighted AS (
  SELECT *, CASE WHEN available > 0 THEN power(available::DOUBLE, 0.5) ELSE 0 END AS weight FROM sizes
), rated AS (
  SELECT source_key, available,
    CASE WHEN available = 0 THEN 1.0
      WHEN sum(weight) OVER () > 0 THEN weight * (sum(available) OVER ())::DOUBLE / sum(weight) OVER () / available ELSE 0.0 END AS rate
  FROM weighted
), steps AS (
  SELECT source_key, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 20)::BIGINT + 1)) AS k FROM rated
), logs AS (
  SELECT *, sum(ln(greatest(k, 1))) OVER (PARTITION BY source_key ORDER BY k) AS log_factorial FROM steps
), probs AS (
  SELECT *, CASE WHEN rate > 0 THEN exp(k * ln(CASE WHEN rate > 0 THEN rate ELSE 1 END) - rate - log_factorial) WHEN k = 0 THEN 1.0 ELSE 0.0 END AS p FROM logs
), cdf AS (
  SELECT source_key, rate, k, sum(p) OVER (PARTITION BY source_key ORDER BY k) AS c FROM probs
), docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, length(text) AS n_chars, coalesce('=' || source, 'null') AS source_key,
    (('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents
), drawn AS (
  SELECT rid, d.doc_id, d.source, d.n_chars, any_value(cdf.rate) AS rate, count(*) FILTER (WHERE c < u) AS copies
  FROM docs d JOIN cdf USING (source_key) GROUP BY 1, 2, 3, 4
), copied AS (
  SELECT doc_id, source, n_chars, rate, unnest(range(1, copies + 1)) AS copy FROM drawn WHERE copies > 0
)
SELECT doc_id, source, copy::INTEGER AS copy, round(rate, 6) AS rate, n_chars,
  ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy || '|order'), 1, 13))::BIGINT AS shuffle_key
FROM copied
"""


@query("op4_poisson_mix", _MIX_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("row.doc_id", "row.source", "copy", F.round("rate", 6).alias("rate"), F.length("row.text").cast("bigint").alias("n_chars"), "shuffle_key")


_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), lengths AS (
  SELECT *, length('<|turn|>') + length(role) + 1 + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?SYS>|/?INST\])', '\1\2\\\3', 'g')) + length('<|end|>') + 1 AS n FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM lengths GROUP BY conv_id
"""


@query("op5_chat_parts", _CHAT_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id bigint, turn bigint, role string, text string")
    formatted = stage(chat_parts.format_conversations(chat_parts.text_turns(turns.unionByName(extra))), "formatted")
    return chat_parts.digests(formatted).drop("attachments", "expanded_tokens")


@query("op6_edit_matching")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return edit_matching.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_quality_trees")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_trees.judge(docs, quality_trees.fit(docs, table(spark, folder, "labels")))


@query("op8_language_kn")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_kn.fit_documents(docs)
    held_out = F.coalesce(language_kn.remainder() == 2, F.lit(False))
    judged = language_kn.judge(docs.withColumn("held_out", held_out), model, "doc_id", "held_out")
    return judged.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op9_passage_chains")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return passage_chains.repeated_passages(table(spark, folder, "documents"))


@query("op10_rans_store")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "token_store")
    token_store.write_store(table(spark, folder, "documents"), path, tokenizer_path())
    return token_store.read_store(spark, path)


_AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
), failed AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS f
  FROM texts
), marks AS (
  SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), counted AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, f
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.l <> b.l AND a.l <> c.l AND a.l <> d.l AND a.l <> e.l AND b.l <> c.l AND b.l <> d.l AND b.l <> e.l AND c.l <> d.l AND c.l <> e.l AND d.l <> e.l
), steps AS (
  SELECT o, s, substr(o, s::INTEGER, 1) AS letter FROM orders, range(1, 6) AS r(s)
), outcomes AS (
  SELECT part, f, n, n_good, n_toxic, o, s, letter,
    least(CASE WHEN contains(f, 'A') THEN strpos(o, 'A') ELSE 9 END, CASE WHEN contains(f, 'B') THEN strpos(o, 'B') ELSE 9 END,
      CASE WHEN contains(f, 'C') THEN strpos(o, 'C') ELSE 9 END, CASE WHEN contains(f, 'D') THEN strpos(o, 'D') ELSE 9 END,
      CASE WHEN contains(f, 'E') THEN strpos(o, 'E') ELSE 9 END) AS first_step
  FROM counted, steps
), report AS (
  SELECT part, o, s, letter,
    coalesce(sum(n) FILTER (WHERE first_step > s), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE first_step = s), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE first_step < s AND contains(f, letter)), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE f = letter), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (WHERE first_step = s), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER (WHERE first_step = s), 0)::BIGINT AS toxic_lost
  FROM outcomes GROUP BY part, o, s, letter
)
SELECT part, o AS filter_order, s::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM report
"""


@query("op11_packed_audit", _AUDIT_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


_SEARCH_SQL = r"""
WITH doc_terms AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)
), lengths AS (
  SELECT rid, count(*) AS n FROM doc_terms GROUP BY rid
), corpus AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths
), counts AS (
  SELECT rid, doc_id, term, count(*) AS tf FROM doc_terms GROUP BY rid, doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, corpus GROUP BY term, docs
), item_terms AS (
  SELECT DISTINCT iid, item_id, term FROM (
    SELECT iid, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS iid, item_id, text FROM benchmark))
), scored AS (
  SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
  FROM item_terms JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (rid), corpus
  GROUP BY iid, item_id, rid, doc_id
), ordered AS (
  SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ordered WHERE rank <= 10
"""


@query("op12_dual_tree", _SEARCH_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return dual_tree.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_BIT_SUMS = ", ".join(f"sum(weight * ((hash >> {j}) & 1)) AS bit{j}" for j in range(64))
_BIT_VALUES = " + ".join(f"CASE WHEN 2 * bit{j} > total THEN {1 << j}::UBIGINT ELSE 0::UBIGINT END" for j in range(64))
_SIMHASH_SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next_t,
    coalesce(lead(doc_id) OVER (ORDER BY doc_id), first(doc_id) OVER (ORDER BY doc_id)) AS next_id
  FROM documents
), sides AS (
  SELECT doc_id, 0 AS side, t FROM docs
  UNION ALL SELECT doc_id, 1, substr(t, 1, n - n // 4) || substr(next_t, 1, n // 4) FROM docs
), words AS (
  SELECT doc_id, side, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS term FROM sides
), hashes AS (
  SELECT term, ('0x' || substr(md5(term), 1, 16))::UBIGINT AS hash FROM (SELECT DISTINCT term FROM words)
), counted AS (
  SELECT doc_id, side, term, count(*) AS tf FROM words GROUP BY doc_id, side, term
), weighed AS (
  SELECT doc_id, side, tf * least(10, greatest(1, length(term) - 2)) AS weight, hash FROM counted JOIN hashes USING (term)
), sums AS (
  SELECT doc_id, side, sum(weight) AS total, {_BIT_SUMS} FROM weighed GROUP BY doc_id, side
), prints AS (
  SELECT doc_id, side, coalesce({_BIT_VALUES}, 0) AS fp FROM sides LEFT JOIN sums USING (doc_id, side)
), near AS (
  SELECT a.fp, sum(b.n) - 1 AS n_near
  FROM (SELECT DISTINCT fp FROM prints WHERE side = 0) a JOIN (SELECT fp, count(*) AS n FROM prints WHERE side = 0 GROUP BY fp) b ON bit_count(xor(a.fp, b.fp)) <= 3
  GROUP BY a.fp
)
SELECT d.doc_id, d.n AS n_chars, sha256(e.t) AS edited_sha256, printf('%016x', p.fp) AS fingerprint, printf('%016x', q.fp) AS edited_fingerprint,
  round(greatest(0, cos(bit_count(xor(p.fp, q.fp)) * (pi() / 64))), 6) AS near_edited,
  round(greatest(0, cos(bit_count(xor(p.fp, r.fp)) * (pi() / 64))), 6) AS near_next, n_near::BIGINT AS n_near
FROM docs d JOIN sides e ON e.doc_id = d.doc_id AND e.side = 1 JOIN prints p ON p.doc_id = d.doc_id AND p.side = 0
  JOIN prints q ON q.doc_id = d.doc_id AND q.side = 1 JOIN prints r ON r.doc_id = d.next_id AND r.side = 0 JOIN near ON near.fp = p.fp
"""


@query("op13_simhash_tables", _SIMHASH_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_tables.with_edits(table(spark, folder, "documents"))
    prints = [simhash_tables.hexed(F.col(c)).alias(n) for c, n in (("fp", "fingerprint"), ("edited_fp", "edited_fingerprint"))]
    return found.select("doc_id", "n_chars", "edited_sha256", *prints, "near_edited", "near_next", "n_near")
