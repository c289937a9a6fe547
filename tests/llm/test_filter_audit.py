"""The packed audit against a plain count over documents, steps and orders."""

import re
from collections import defaultdict
from itertools import permutations

import pytest

from sitewarden.llm import filter_audit

SCHEMA = "doc_id bigint, text string, source string, mask string, part int, n double"


def fails(rows):
    """Letters that each (doc_id, text, source) row fails."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = any(doc_id is not None and i is not None and i < doc_id and (t or "") == text for i, t, _ in rows)
        tests = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            re.search(r"[#$%&*|]", text) is not None,
            smaller,
        ]
        out.append("".join(f for f, t in zip("ABCDE", tests, strict=True) if t))
    return out


def plain(rows, quality, toxic):
    found = defaultdict(lambda: [0] * 7)
    failed = fails(rows)
    for part in {s or "" for _, _, s in rows}:
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                row = found[part, "".join(order), step]
                for (doc_id, _, source), f in zip(rows, failed, strict=True):
                    if (source or "") != part:
                        continue
                    earlier = any(x in f for x in order[: step - 1])
                    removed = letter in f and not earlier
                    row[0] += not earlier and not removed
                    row[1] += removed
                    row[2] += letter in f and earlier
                    row[3] += f == letter
                    row[4] += removed and doc_id in quality
                    row[5] += removed and doc_id in toxic
                    shapley[letter] += removed
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                found[part, "".join(order), step][6] = shapley[letter]
    return {k: tuple(v) for k, v in found.items()}


ROWS = [
    (1, None, None),
    (2, "", ""),
    (3, "", "a"),
    (4, "many " * 300, "a"),
    (5, "many " * 300, "b"),
    (5, "many " * 300, "b"),
    (None, "many " * 300, "b"),
    (6, " ".join(f"w{i}" for i in range(250)), "b"),
    (6, " ".join(f"w{i}" for i in range(250)), "b"),
    (7, " ".join(f"W{i}" for i in range(250)) + " #", "a"),
    (8, "SHORT | text\x0bwith\rodd\tblanks here É", "c"),
    (9, " ".join(f"w{i}" for i in range(60_000)), "c"),
    (10, "x\x00y", "c"),
]


def test_audit_equals_the_plain_count(spark):
    docs = spark.createDataFrame([(*r, "m", 1, 0.5) for r in ROWS], SCHEMA)
    labels = spark.createDataFrame([(4, 1, 0, 9), (4, None, 1, 9), (5, 0, 1, 9), (7, 1, None, 9), (None, 1, 1, 9), (99, 1, 1, 9)], "doc_id bigint, quality int, toxic int, part int")
    found = filter_audit.audit_documents(docs, labels).collect()
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found} == plain(ROWS, {4, 7}, {4, 5})
    assert len(found) == 600 * 4
    assert filter_audit.audit_documents(docs.limit(0), labels).count() == 0
    unlabelled = filter_audit.audit_documents(docs, labels.limit(0))
    assert unlabelled.where("good_lost > 0 or toxic_lost > 0").count() == 0


def test_fields_do_not_overflow_and_other_filter_sets_work(spark):
    counts = spark.createDataFrame([("x", 3, True, False, 1 << 61), ("x", 2, False, False, 1 << 61), ("y", 0, False, False, 1)], "part string, mask int, good boolean, toxic boolean, n bigint")
    found = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(counts, "PQ").collect()}
    assert len(found) == 8
    first, second = found["x", "PQ", 1], found["x", "PQ", 2]
    assert (first.kept, first.removed, first.redundant, first.unique_fails, first.good_lost) == (1 << 61, 1 << 61, 0, 0, 1 << 61)
    assert (second.kept, second.removed, second.redundant, second.unique_fails) == (0, 1 << 61, 1 << 61, 1 << 61)
    assert found["x", "QP", 1].removed == 1 << 62 and found["y", "QP", 2].kept == 1
    for bad in ("", "AA", "ABCDEFG"):
        with pytest.raises(ValueError):
            filter_audit.audit(counts, bad)


def test_a_hot_text_and_part_reach_the_sum_as_few_rows(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) as text", "if(id % 2 = 0, 'hot', concat('s', id % 5)) as source")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    counts = filter_audit.mask_counts(docs, labels)
    assert counts.groupBy("part").count().agg({"count": "max"}).first()[0] <= 128
    assert counts.agg({"n": "sum"}).first()[0] == 3000
    copies = filter_audit.audit(counts).where("filter_order = 'EABCD' and step = 1").agg({"removed": "sum"}).first()[0]
    assert copies == 999
