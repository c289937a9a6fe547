"""Fingerprints, edited texts and the block tables against plain Python."""

import hashlib
import random
from collections import Counter

import pytest

from sitewarden.llm import simhash_tables

SCHEMA = "doc_id bigint, text string, id string, h int, fp double, part string"


def plain_print(text):
    words = [w for w in text.translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]
    votes = [0] * 64
    for word in words:
        weight = min(max(len(word) - 2, 1), 10)
        bits = int(hashlib.md5(word.encode()).hexdigest()[:16], 16)
        for j in range(64):
            votes[j] += weight if bits >> j & 1 else -weight
    return sum(1 << j for j, v in enumerate(votes) if v > 0)


def unsigned(fp):
    return fp & (2**64 - 1)


def plain(rows):
    """Counter of (doc_id, n_chars, sha, fp, edited fp, n_near) of rows with one text per doc_id."""
    texts = {i: t or "" for i, t in rows}
    ids = sorted(texts, key=lambda i: (i is not None, i or 0))
    prints = {i: plain_print(t) for i, t in texts.items()}
    out = Counter()
    for k, i in enumerate(ids):
        text, following = texts[i], texts[ids[(k + 1) % len(ids)]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        near = sum((prints[j] ^ prints[i]).bit_count() <= 3 for j, _ in rows) - 1
        for j, _ in rows:
            if j == i:
                out[i, len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[i], plain_print(edited), near] += 1
    return out


def found(frame):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, unsigned(r.fp), unsigned(r.edited_fp), r.n_near) for r in frame.collect())


def test_edited_texts_and_prints(spark):
    rng = random.Random(3)
    words = ["a", "of", "word", "längere", "日本語", "x" * 30, "extraordinary"]
    rows = [(i * 7, rng.choice([" ", "\n", "\t \x0b", "  "]).join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(40)]
    rows += [(1000, None), (1001, ""), (1002, " \n "), (None, "a document without id"), (1003, "one"), (1004, "ends in a blank "), (1005, "😀" * 9), (1006, "  starts"), (1007, "same text here"), (1008, "same text here")]
    rows += [(1009, " ".join(rng.choices(words, k=9000))), (5000, "twice"), (5000, "twice")]
    docs = spark.createDataFrame([(*r, "q", 1, 0.5, "p") for r in rows], SCHEMA).repartition(5)
    result = simhash_tables.with_edits(docs)
    assert found(result) == plain(rows)
    same = {r.fp for r in result.where("doc_id in (1007, 1008)").collect()}
    assert len(same) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in result.collect())
    assert Counter((r.doc_id, unsigned(r.fp)) for r in simhash_tables.fingerprint(docs).collect()) == Counter({k: v for (i, _, _, f, _, _), v in plain(rows).items() for k in [(i, f)]})


def test_few_documents(spark):
    docs = spark.createDataFrame([(1, "alone with nine more words in here")], "doc_id bigint, text string")
    assert found(simhash_tables.with_edits(docs)) == plain([(1, "alone with nine more words in here")])
    assert simhash_tables.with_edits(docs.limit(0)).count() == 0
    # two texts of one id are two documents
    twice = spark.createDataFrame([(1, "a first text of this id"), (1, "and another one")], "doc_id bigint, text string")
    assert {(r.n_chars, unsigned(r.fp)) for r in simhash_tables.with_edits(twice).collect()} == {(len(t), plain_print(t)) for t in ("a first text of this id", "and another one")}


@pytest.mark.parametrize("radius, blocks", [(0, 1), (3, 6), (3, 4), (5, 8)])
def test_block_tables_find_every_pair_once(spark, radius, blocks, monkeypatch):
    monkeypatch.setattr(simhash_tables, "HOT_FRONT", 8)  # salts, too
    rng = random.Random(radius)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    for p in list(prints):
        for _ in range(rng.randint(0, 6)):
            near = p
            for bit in rng.sample(range(64), rng.randint(1, radius + 2)):
                near ^= 1 << bit
            prints.add(near)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p, 2) for p in signed], "fp bigint, n bigint")
    pairs = [(r.a, r.b, r.bits) for r in simhash_tables.near_pairs(frame, radius, blocks).collect()]
    expected = {(a, b, (unsigned(a) ^ unsigned(b)).bit_count()) for a in signed for b in signed if a < b}
    expected = {x for x in expected if x[2] <= radius}
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected


def test_too_few_blocks_are_refused(spark):
    with pytest.raises(ValueError):
        simhash_tables.near_pairs(spark.createDataFrame([(1, 1)], "fp bigint, n bigint"), 3, 3)


def test_main_path_has_no_python(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, "more text")], "doc_id bigint, text string")
    rows = simhash_tables.keyed(docs)
    order = simhash_tables.in_order(rows)
    for frame in (order, simhash_tables.edited_prints(simhash_tables.edited_texts(rows, order)), simhash_tables.with_edits(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
