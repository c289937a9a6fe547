"""Dual-tree search against the plain ranking of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sitewarden.llm import dual_tree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [] if text is None else TERM.findall(text.translate(UPPER))


def plain(docs, items, k=10):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item_id, text in items:
        scored = []
        for doc_id, counts, size in held:
            m = 10 + (90 * size * n) // total
            score = 0
            for t in set(terms(text)):
                if tf := counts[t]:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            out[item_id, rank, doc_id, -score] += 1
    return out


def found(frame):
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["École", "日本", "x-y", "A.b", "the", "THE", "1st"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(n)], words


@pytest.fixture
def tables(spark):
    docs, words = corpus(5, 700)
    docs += [(2000, None), (2001, ""), (2002, "?!"), (None, "w5 w6 the"), (2003, "w5 w6 the"), (2003, "w5 w6 the"), (2004, "école w1 " * 30_000), *[(3000 + i, "w300 w301 tie") for i in range(30)]]
    rng = random.Random(9)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(60)]
    items += [(100, None), (101, "..."), (102, "tie W300"), (102, "tie W300"), (103, "w5"), (103, "w6 the THE"), (None, "école"), (104, "nowhere"), (105, " ".join(words) * 3)]
    return (
        docs,
        items,
        spark.createDataFrame([(*d, "x", 1.5, 3) for d in docs], "doc_id bigint, text string, item_id string, score double, rank int").repartition(7),
        spark.createDataFrame([(*i, 7, "y") for i in items], "item_id bigint, text string, doc_id int, item string"),
    )


def test_equal_to_the_plain_ranking(tables):
    docs, items, doc_rows, item_rows = tables
    expected = plain(docs, items)
    assert found(dual_tree.search(doc_rows, item_rows)) == expected
    # many blocks of items, another partitioning
    assert found(dual_tree.search(doc_rows.repartition(2), item_rows, block_chars=1500)) == expected


def test_small_chunks_and_samples_change_nothing(tables, monkeypatch):
    docs, items, doc_rows, item_rows = tables
    monkeypatch.setattr(dual_tree, "NODE_CELLS", 3000)
    monkeypatch.setattr(dual_tree, "SAMPLE", 5)
    assert found(dual_tree.search(doc_rows, item_rows, k=3)) == plain(docs, items, 3)


def test_empty_tables(tables):
    _, _, doc_rows, item_rows = tables
    assert dual_tree.search(doc_rows.limit(0), item_rows).count() == 0
    assert dual_tree.search(doc_rows, item_rows.limit(0)).count() == 0
    assert dual_tree.search(doc_rows.where("text is null"), item_rows).count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    # 40 subjects with ten terms each
    items = dual_tree.Items.of([b" ".join(b"t%d" % (10 * s + t) for t in rng.choice(10, 8)) for s in range(40)])
    weights = rng.integers(1, 9000, len(items.vocabulary))
    sizes = rng.integers(0, 5, 2000)
    held = [items.terms[rng.integers(40)][:s] for s in sizes]
    terms_ = np.concatenate(held)
    first = np.concatenate([[0], np.cumsum([len(h) for h in held])])
    impacts = rng.integers(1, 10**6, len(terms_))
    docs = dual_tree.Documents(first, terms_, impacts, weights, len(weights))
    assert [level.shape[1] for level in docs.levels] == [1, 4, 32, 250]
    search = dual_tree.Search(items, weights, np.zeros(40, dtype=np.int64))
    search.add(docs, list(range(2000)))
    held = [dict(zip(terms_[a:b].tolist(), impacts[a:b].tolist(), strict=True)) for a, b in zip(first, first[1:], strict=False)]
    for i, wanted in enumerate(items.terms):
        scores = sorted(((-sum(int(weights[t]) * h.get(t, 0) for t in wanted.tolist()), d) for d, h in enumerate(held)))
        assert [(s, d) for s, _, d in search.best[i]] == [x for x in scores[:10] if x[0] < 0]
    assert search.visited < 40 * 250 / 4
