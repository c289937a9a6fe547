"""Token store, rollups, mixing, chat formatting, and the queries that have SQL."""

import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from sitewarden.llm import chat_parts, mixing, rans, token_cache, token_rollup, token_store
from sitewarden.llm.queries import QUERIES, SQL, tokenizer_path
from sitewarden.session import new_path

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.mark.parametrize("n", [0, 1, 5, rans.BLOCK_TOKENS, rans.BLOCK_TOKENS * 2 + 17])
@pytest.mark.parametrize("kinds", [1, 2, 40_000])
def test_rans_round_trip(n, kinds):
    rng = np.random.default_rng(n + kinds)
    ids = (rng.zipf(1.3, n) % kinds).astype(np.uint32)
    blob = rans.encode([7, None], np.array([n, 0]), ids)
    segment = rans.Segment(blob)
    assert segment.doc_ids == [7, None] and segment.lengths.tolist() == [n, 0]
    assert np.array_equal(segment.blocks(), ids)
    if segment.n_blocks > 1:
        size = segment.steps * rans.LANES
        assert np.array_equal(segment.blocks(1, 2), ids[size : 2 * size])


def test_rans_is_near_the_entropy_and_finds_damage():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.02, 400_000), 500).astype(np.uint32)
    share = np.bincount(ids) / len(ids)
    bits = -(share[share > 0] * np.log2(share[share > 0])).sum() * len(ids)
    blob = rans.encode([1], np.array([len(ids)]), ids)
    assert len(blob) * 8 < 1.03 * bits + 8 * 512 * 7
    with pytest.raises(rans.Corrupt):
        rans.Segment(blob[:-9] + bytes([blob[-9] ^ 1]) + blob[-8:]).blocks()
    with pytest.raises(rans.Corrupt):
        rans.Segment(blob[:60] + bytes([blob[60] ^ 1]) + blob[61:])


def test_cut_encoding_equals_whole_texts():
    encoder = token_cache.Encoder(tokenizer_path())
    assert encoder.by_cuts
    rng = random.Random(1)
    pieces = [*"ab é'sL1,.\n\t  \r<|　 日\x0b\x1c", "<|endoftext|>", " the", "  ", "x" * 80, " \n "]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(5000)]
    expected = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        ids, counts = encoder.ids(pa.array(texts))
        assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == expected


def test_added_tokens_in_a_text_are_what_the_library_makes_of_them():
    from tokenizers import Tokenizer

    plain, encoder = Tokenizer.from_file(tokenizer_path()), token_cache.Encoder(tokenizer_path())
    token = next(t.content for t in plain.get_added_tokens_decoder().values())
    texts = ["a b", f"a {token} b", token, "", None, f"x{token}{token} y  z", token[:-1], f" {token}\n", "the end"]
    for some in (texts, texts[1:3], texts[:1], []):
        ids, counts = encoder.ids(pa.array(some, pa.string()))
        assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])][: len(some)] == [plain.encode(t or "", add_special_tokens=False).ids for t in some]
    assert plain.token_to_id(token) in encoder.ids(pa.array(texts[1:2]))[0]


def test_no_cut_goes_to_the_model_twice(monkeypatch):
    encoder, seen = token_cache.Encoder(tokenizer_path()), []
    encode = encoder._encode_cuts

    def recorded(cuts):
        seen.extend(map(str, cuts))
        return encode(cuts)

    monkeypatch.setattr(encoder, "_encode_cuts", recorded)
    # the same words alone, before a sign, in a table, in a text with a run of white space, and in a later step
    texts = ["see the word and the end", "the word, the end. the|end|word", "a  the word\n \nthe end\tword", None, "x" * 5000 + " é日本 é日本."]
    plain = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for step in (texts, texts[::-1], texts):
        ids, counts = encoder.ids(pa.array(step))
        assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == [plain[texts.index(t)] for t in step]
    assert " the" in seen and len(seen) == len(set(seen))


def test_little_memory_gives_the_same_ids(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdeé日,.\n", k=rng.randint(0, 9))) for _ in range(200)) for _ in range(60)]
    encoder = token_cache.Encoder(tokenizer_path())
    expected = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(token_cache, "KNOWN_BYTES", 2_000)
    for size in (1, 7, 60):
        for first in range(0, 60, size):
            ids, counts = encoder.ids(pa.array(texts[first : first + size]))
            assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == expected[first : first + size]


def test_a_vocabulary_without_all_bytes_encodes_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.BPE({"a": 0, "b": 1, "ab": 2}, [("a", "b")]))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tokenizer.save(str(tmp_path / "few.json"))
    encoder = token_cache.Encoder(str(tmp_path / "few.json"))
    ids, counts = encoder.ids(pa.array(["ab a", "ba é", None]))
    assert ids.tolist() == [2, 0, 1, 0] and counts.tolist() == [2, 2, 0]


def test_token_store_reads_back(spark):
    from tokenizers import Tokenizer

    rows = [(5, "one two", None, None), (3, None, None, None), (None, "x", None, None), (3, "", None, None), (9, "long words here " * 20_000, None, None), (9, "b", None, None), (9, "b", None, None)]
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], SCHEMA + ", part int, segment string")
    path = new_path(spark, "store")
    token_store.write_store(docs, path, tokenizer_path(), partitions=3)
    found = sorted(token_store.read_store(spark, path).collect(), key=lambda r: r.start)
    plain = Tokenizer.from_file(tokenizer_path())
    expected = {(d, len(i), zlib.crc32(np.array(i, dtype="<u4").tobytes())) for d, t, *_ in rows for i in [plain.encode(t or "", add_special_tokens=False).ids + [2]]}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in found} == expected
    assert [r.doc_id for r in found] == [None, 3, 3, 5, 9, 9, 9]
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    ids = {(r.doc_id, tuple(r.ids)) for r in token_store.read_ids(spark, path).where("doc_id = 5").collect()}
    assert ids == {(5, (*plain.encode("one two").ids, 2))}
    empty = new_path(spark, "store")
    token_store.write_store(docs.where("false"), empty, tokenizer_path())
    assert token_store.read_store(spark, empty).count() == 0


def test_rollup_is_additive_and_idempotent(spark):
    rollup = token_rollup.Rollup(spark, new_path(spark, "rollup"))
    assert rollup.totals().count() == 0
    schema = "kind string, source string, lang string, tokenizer string, tokens bigint, old_tokens bigint, docs int"
    first = spark.createDataFrame([("insert", "a", "en", "t1", 10, None, 0), ("insert", "a", None, "t1", 5, None, 0), ("insert", None, "en", "t1", None, None, 0), ("insert", "a", "en", "t1", 10, None, 0)], schema)
    assert rollup.commit("b1", first) and not rollup.commit("b1", first)
    assert rollup.commit("b2", spark.createDataFrame([("revise", "a", "en", "t1", 7, 10, 0), ("delete", "a", None, "t1", 5, None, 0)], schema))
    assert rollup.commit("b3", first.where("false"))
    before = {tuple(r) for r in rollup.totals().collect()}
    assert before == {("a", "en", "t1", 2, 17), (None, "en", "t1", 1, 0)}
    rollup.compact()
    assert {tuple(r) for r in rollup.totals().collect()} == before
    assert not rollup.commit("b2", first) and rollup.commit("b4", first)
    assert ("a", "en", "t1", 4, 37) in {tuple(r) for r in rollup.totals().collect()}
    # a folder without its mark is the rest of a failed commit
    spark.createDataFrame([("a", "en", "t1", 1, 1)], token_rollup.SCHEMA).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{rollup.root}/batch=b9")
    assert "b9" not in rollup.committed() and rollup.commit("b9", first)
    with pytest.raises(Exception, match="unknown kind"):
        rollup.commit("b10", spark.createDataFrame([("move", "a", "en", "t1", 1, 1, 0)], schema))


def test_mixing_meets_its_targets(spark):
    rows = [(i, "x" * 100, None, "big" if i % 10 else "small") for i in range(4000)]
    docs = spark.createDataFrame([(*r, "k", 3) for r in rows], SCHEMA + ", source_key string, copy int")
    mixed = mixing.mixed_documents(docs, weights={"big": 1.0, "small": 1.0})
    assert mixed.columns == docs.columns
    n = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["big"] - 2000) < 200 and abs(n["small"] - 2000) < 200
    again = mixing.mix(docs.repartition(5), weights={"big": 1.0, "small": 1.0})
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in again.select("row.doc_id").collect())
    order = [r.doc_id for r in mixed.where("source = 'big'").collect()]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.1
    copies = again.where("row.source = 'small'").groupBy("row.doc_id").count().groupBy("count").count().collect()
    share = {r["count"]: r[1] / 400 for r in copies}
    assert abs(share[5] - 5**5 * np.exp(-5) / 120) < 0.08


def test_mixing_is_the_same_with_many_sources(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 50, "x" * (i + 1), None, f"s{i % 7}") for i in range(300)], SCHEMA)
    small = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "MAX_BROADCAST_BYTES", 3)
    assert sorted(map(str, mixing.mix(docs).collect())) == small


def test_mixing_large_rates_and_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", None, ""), (None, "abc", None, "s"), (3, "abc", None, "s"), (3, "abc", None, "s"), (4, "y" * 900_000, None, "huge")]
    docs = spark.createDataFrame(rows, SCHEMA)
    rates = {r.source_key: r.rate for r in mixing.rates(docs, weights={"s": 1.0, "huge": 0.0}, total=9000).collect()}
    assert rates == {"null": 1.0, "=": 1.0, "=s": 1000.0, "=huge": 0.0}
    n = {r.source: r["count"] for r in mixing.mixed_documents(docs, weights={"s": 1.0}, total=9000).groupBy("source").count().collect()}
    assert abs(n["s"] - 3000) < 400 and "huge" not in n
    assert mixing.mixed_documents(docs.where("false")).count() == 0


def test_escaping_is_reversible_and_leaves_no_control_string():
    rng = random.Random(3)
    pieces = ["<", "|", "\\", "[", "]", "/", "s>", "INST]", "SYS>", "SYS>>", "<s>", "</s>", "[/INST]", "<|end|>", "a", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 8)))
        safe = chat_parts.escape(text)
        assert chat_parts.unescape(safe) == text
        assert not any(c in safe for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<SYS>", "<<SYS>>"))


def test_parts_flatten_in_order():
    part = dict.fromkeys(("text", "ref", "width", "height", "seconds", "pages"))
    parts = [part | {"kind": "text", "text": "see <"}, part | {"kind": "text", "text": "| this"}, part | {"kind": "image", "ref": "i.png", "width": 57, "height": 28}, None, part | {"kind": "audio", "ref": "a.wav", "seconds": 1.5}, part | {"kind": "document", "pages": 2}, part | {"kind": "text", "text": None}, part | {"kind": "text", "text": "end"}]
    text, spans, refs = chat_parts.format_turn("user", parts)
    assert text == "<|turn|>user\nsee <\\| this<|image:0|><|audio:1|><|document:2|>end<|end|>\n"
    assert [chat_parts.unescape(text[a:b]) for a, b in spans] == ["see <| this", "end"]
    assert refs == [(0, "image", "i.png", 3), (1, "audio", "a.wav", 38), (2, "document", None, 1200)]
    with pytest.raises(ValueError):
        chat_parts.format_turn("user", [part | {"kind": "video"}])


def test_conversations_in_chunks_and_odd_rows(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"text {t}<|end|>\n") for t in range(40)] + [(2, None, None, None), (None, 1, "a\nb", "x"), (None, 0, "user", "y"), (2, 1, "assistant", ""), (3, 0, "user", "z" * 300_000), (3, 0, "user", "z")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, chunk int")
    formatted = chat_parts.format_conversations(chat_parts.text_turns(turns), chunk_chars=200).cache()
    assert formatted.where("conv_id = 1").count() > 3
    small = {r.conv_id: r for r in chat_parts.digests(formatted).collect()}
    whole = {r.conv_id: r for r in chat_parts.digests(chat_parts.format_conversations(chat_parts.text_turns(turns))).collect()}
    assert small == whole and set(whole) == {1, 2, 3, None}
    assert whole[1].loss_chars == sum(len(r[3]) for r in rows if r[0] == 1 and r[2] == "assistant")
    assert whole[None].n_turns == 2
    first = formatted.where("conv_id is null").first()
    assert [r for r, _ in chat_parts.read_turns(first.text)] == ["user", "a\nb"]
    assert chat_parts.digests(chat_parts.format_conversations(chat_parts.text_turns(turns.where("false")))).count() == 0


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    result = con.execute(SQL[key])
    names = sorted(c[0] for c in result.description)
    df = QUERIES[key](spark, DATA)
    assert sorted(df.columns) == names
    theirs = result.fetchdf()[names].astype(str)
    ours = df.toPandas()[names].astype(str)
    assert sorted(map(tuple, ours.to_numpy())) == sorted(map(tuple, theirs.to_numpy()))


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, step in corpus_pipeline.STAGES[:3]:
        docs = step(spark, docs, DATA).cache()
        assert docs.columns == columns, name
        seen.append(docs.count())
    assert seen[0] >= seen[1] > seen[2] > seen[3] > 0.5 * seen[0]
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 50
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where("false"), DATA).count() == 0
