"""Near copies of the pipeline against all pairs."""

import random

import numpy as np

import corpus_pipeline
from sitewarden.llm import near_copies

WORDS = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st")]
SCHEMA = "doc_id bigint, text string, lang string"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_kept(rows):
    """Indexes of the rows that stay, of rows (doc_id, text) with non-null ids and no equal rows."""
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8:
                parent[find(i)] = find(j)
    best = {}
    for i in range(len(rows)):
        root = find(i)
        if root not in best or rows[i][0] < rows[best[root]][0]:
            best[root] = i
    return set(best.values())


def copies(rng, common):
    texts = []
    for group in range(40):
        words = rng.choices(WORDS, k=rng.randint(3, 400))
        for _ in range(30 if group == 0 else rng.randint(1, 4)):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 50))):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy) + (" " + common if rng.random() < 0.5 else ""))
    rng.shuffle(texts)
    return texts


def test_stage_equals_all_pairs_of_five_word_similarity(spark):
    rng = random.Random(5)
    texts = copies(rng, "a line that half of all documents have at their end")
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA)
    found = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    expected = plain_kept(list(enumerate(texts)))
    assert found == expected and 30 < len(expected) < len(texts) - 20


def test_copies_near_the_limit_go(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(40):
        words = rng.choices(WORDS, k=200)
        texts.append(" ".join(words))
        for at in (30, 100, 170):
            words[at] = "edited"
        texts.append(" ".join(words))
    assert all(0.8 <= similarity(shingles(a), shingles(b)) < 0.9 for a, b in zip(texts[::2], texts[1::2], strict=True))
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in near_copies.keep_first(docs).collect()} == set(range(0, 80, 2))


def test_rows_that_share_an_id_and_odd_rows(spark):
    rows = [(1, "a b c d e f g"), (1, "quite other words are in this text"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (None, "a b c d e f g"), (None, None), (5, "x y")]
    docs = spark.createDataFrame([(*r, "en") for r in rows], SCHEMA)
    kept = near_copies.keep_first(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(1, rows[0][1]), (1, rows[1][1]), (3, None), (None, rows[0][1]), (None, None), (5, "x y")], key=str)
    assert near_copies.keep_first(docs.where("false")).count() == 0


def test_columns_named_like_the_join_keys(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, 1, "a"), (2, text, 2, "b"), (3, "other words here", 3, "c"), (3, "other words here", 3, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, gone_key int, Twice_Key string")
    found = near_copies.keep_first(docs)
    assert found.columns == docs.columns
    assert sorted(r.doc_id for r in found.collect()) == [1, 3]


def test_bitmaps_differ_in_no_more_places_than_the_sets():
    rng = np.random.default_rng(3)
    for n in (1, 30, 400, 3000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[len(a) // 10 :], rng.integers(0, 2**63, n // 10, dtype=np.uint64)]))
        apart = int(np.bitwise_count(near_copies.bitmap(a).view(np.uint64) ^ near_copies.bitmap(b).view(np.uint64)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_the_trees_give_the_pairs_of_few_edits(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(60):
        words = rng.choices(WORDS, k=600)
        texts.append(" ".join(words))
        texts.append(" ".join([*words, "end"]))
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA)
    rows = near_copies.set_rows(docs)
    ids = {r.sid: r.doc_id for r in rows.select("sid", "doc_id").collect()}
    pairs = {tuple(sorted((ids[r.a], ids[r.b]))) for r in near_copies.print_pairs(rows).collect()}
    assert len(pairs & {(i, i + 1) for i in range(0, 120, 2)}) >= 54


def test_a_shared_line_and_a_large_group_make_few_pairs(spark, monkeypatch):
    """Texts that share keys but are unlike each other are dropped before their texts move; a group's members meet few of their own."""
    rng = random.Random(10)
    line = [f"common{i}" for i in range(12)]
    texts = [" ".join(line + rng.choices(WORDS, k=30)) for _ in range(150)]
    words = rng.choices(WORDS, k=80)
    for _ in range(150):
        copy = list(words)
        copy[rng.randrange(80)] = rng.choice(WORDS)
        texts.append(" ".join(copy))
    counts = []
    check = near_copies.verified

    def counted(docs, prints, pairs, repeated=True):
        counts.append(pairs.count())
        return check(docs, prints, pairs, repeated)

    monkeypatch.setattr(near_copies, "verified", counted)
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA)
    found = {r.doc_id for r in near_copies.keep_first(docs).collect()}
    assert found == plain_kept(list(enumerate(texts)))
    assert sum(counts) <= (near_copies.SPOKES + 1) * len(texts)


def test_a_pair_leaves_the_key_join_once(spark):
    """Sets with many shared keys: one row for each pair, not one for each key and side."""
    maps = ", ".join(f"{m} bigint" for m in near_copies._MAP)
    # 1 and 2 share 40 keys, and 20 with 3, every second one; 4 and 5 are the component that is largest at each key
    holders = [(k, sid) for k in range(40) for sid in (1, 2, 4, 5, *([3] if k % 2 else []))]
    labels = {1: 1, 2: 2, 3: 3, 4: 4, 5: 4}
    rows = [(sid, k, 190, k, labels[sid], 4, *[0] * len(near_copies._MAP)) for k, sid in holders]
    entries = spark.createDataFrame(rows, f"sid bigint, hash bigint, n int, pos int, label bigint, largest bigint, {maps}")
    met = sorted(tuple(r) for r in near_copies.meetings(near_copies.with_before(entries)).collect())
    assert met == [(1, 2), (1, 3), (1, 4), (1, 5), (2, 3), (2, 4), (2, 5), (3, 4), (3, 5)]


def test_a_pair_whose_shared_keys_lie_far_apart_is_met(spark):
    """Keys of their own between two shared ones: the first shared one still brings the pair."""
    maps = ", ".join(f"{m} bigint" for m in near_copies._MAP)
    shared, own = [0, 100], {sid: [sid * 1000 + i for i in range(30)] for sid in (1, 2)}
    keys = {sid: [shared[0], *own[sid], shared[1]] for sid in (1, 2)}
    rows = [(sid, k, 200, i, sid, 1, *[0] * len(near_copies._MAP)) for sid in (1, 2) for i, k in enumerate(keys[sid])]
    entries = spark.createDataFrame(rows, f"sid bigint, hash bigint, n int, pos int, label bigint, largest bigint, {maps}")
    assert {tuple(r) for r in near_copies.meetings(near_copies.with_before(entries)).collect()} == {(1, 2)}
