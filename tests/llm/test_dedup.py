"""SimHash groups, repeated passages and edit matching against plain versions."""

import random

import numpy as np
import pyarrow as pa
import xxhash

from sitewarden.llm import edit_matching, passage_chains, simhash_vp

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, texts, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], schema)


def odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "a b c d e f g"), (None, None), (3, "a b c d e f g"), (3, "a b c d e f g"), (4, "x " * 30_000), (5, "."), (6, "é" * 50)]
    return spark.createDataFrame([(d, t, None, None, None, 1, "z", 2) for d, t in rows], SCHEMA + ", fp int, hash string, component_id int")


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(ids, prints, max_bits=3):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i, d in enumerate(ids):
        groups.setdefault(find(i), []).append(d)
    return {i: min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(ids))}


def near_texts():
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        words = sentence(rng, rng.randint(1, 400)).split()
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else "\t".join(copy))
    rng.shuffle(texts)
    return texts


def test_simhash_equals_all_pairs(spark):
    texts = near_texts()
    found = {r.doc_id: r for r in simhash_vp.classes(frame(spark, texts)).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    assert [found[i].fp & (2**64 - 1) for i in range(len(texts))] == prints
    expected = plain_components(range(len(texts)), prints)
    assert {i: r.component_id for i, r in found.items()} == expected
    assert len(set(expected.values())) < len(texts)


def test_simhash_trees_lose_no_link_when_deep(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    near = base[:400].copy()
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)
    dense = base[0] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64))
    prints = np.unique(np.concatenate([base, near, dense]))
    trees = [simhash_vp.Tree(s, 6) for s in simhash_vp.halves(prints)]
    pairs = {(int(a), int(b)) for i, a in enumerate(prints) for b in prints[i + 1 :][np.bitwise_count(prints[i + 1 :] ^ a) <= 3]}
    met = set()
    for tree, values in zip(trees, simhash_vp.halves(prints), strict=True):
        home = tree.home(values)
        who, leaf = tree.reached(values, 1)
        visitors = {}
        for i, at in zip(who, leaf, strict=True):
            visitors.setdefault(at, set()).add(int(prints[i]))
        met |= {(a, b) for a, b in pairs if b in visitors[home[np.searchsorted(prints, a)]]}
        assert len(who) < 40 * len(prints)
    assert met == pairs and len(pairs) > 400


def test_large_shards_are_parted_without_loss():
    rng = np.random.default_rng(9)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (4000, 4), dtype=np.uint64)
    flips[rng.random((4000, 4)) < 0.5] = 0
    prints = np.unique(np.concatenate([rng.choice(centres, 4000) ^ np.bitwise_xor.reduce(flips, axis=1), rng.integers(0, 1 << 63, 1000, dtype=np.uint64)]))
    assert len(prints) > simhash_vp.LARGE_SHARD

    def groups(*edges):
        parent = {int(p): int(p) for p in prints}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                x, y = find(x), find(y)
                parent[max(x, y)] = min(x, y)
        return [find(int(p)) for p in prints]

    parted = [simhash_vp.shard_links(prints, prints, half, 3) for half in (0, 1)]
    assert groups(*parted) == groups(simhash_vp.local_links(prints, prints, 3))


def test_simhash_keeps_one_of_each_group_and_odd_rows(spark):
    docs = odd_rows(spark)
    found = simhash_vp.classes(docs).collect()
    assert len(found) == 10
    assert {r.component_id for r in found if r.doc_id == 2} == {1}
    kept = simhash_vp.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda d: (d is None, d or 0))
    assert [i for i in ids if i is not None] == [1, 3, 4, 5, 6]
    assert simhash_vp.keep_first(docs.where("false")).count() == 0


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        new = [i + 1]
        for j, c in enumerate(text):
            new.append(min(row[j] + (p != c), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_myers_equals_the_table():
    rng = random.Random(2)
    for _ in range(200):
        pattern = "".join(rng.choices("abc", k=rng.randint(1, 80)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 120)))
        limit = rng.randint(0, 20)
        expected = plain_distance(pattern, text)
        found = edit_matching.best_match(pattern, text, limit)
        assert (found[0] if found else None) == (expected if expected <= limit else None)


def test_edit_matching_finds_all_within_budget(spark):
    rng = random.Random(8)
    items = [(i, sentence(rng, rng.randint(10, 40))) for i in range(12)] + [(50, None), (51, "of the"), (52, "")]
    texts = []
    for _ in range(80):
        passage = list(rng.choice(items[:12])[1])
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(passage))
            passage[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "zz"])
        texts.append(sentence(rng, 30) + " \n" + "".join(passage).upper() + "\t" + sentence(rng, 30) if rng.random() < 0.7 else sentence(rng, 60))
    docs = frame(spark, [*texts, None, ""])
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = set()
    for d, text in enumerate(texts):
        for i, item in items[:12]:
            distance = plain_distance(edit_matching.normal(item), edit_matching.normal(text))
            if distance <= max(1, int(0.05 * len(edit_matching.normal(item)))):
                expected.add((d, i, distance))
    found = {(r.doc_id, r.item_id, r.distance) for r in edit_matching.matches(docs, benchmark).collect()}
    assert found == expected and len(expected) > 20
    clean = {r.doc_id for r in edit_matching.keep_clean(docs, benchmark).collect()}
    assert clean == set(range(82)) - {d for d, _, _ in expected}
    assert edit_matching.matches(docs, benchmark.where("false")).count() == 0


def test_edit_matching_blocks_and_odd_rows(spark):
    rng = random.Random(9)
    items = [(i, sentence(rng, 30)) for i in range(6)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    blocks = list(edit_matching.item_blocks(benchmark, block_chars=300))
    assert len(blocks) > 1
    assert sorted(i for b in blocks for i, _ in b) == list(range(6))
    docs = odd_rows(spark)
    assert edit_matching.keep_clean(docs, benchmark).count() == docs.count()
    assert edit_matching.keep_clean(docs, benchmark).columns == docs.columns


def test_short_items_are_found_between_word_bounds(spark):
    benchmark = spark.createDataFrame([(1, "What is  two plus two?"), (2, "yes"), (3, "two plus six"), (4, "\u4eca\u5929\u5929\u6c14\u600e\u4e48\u6837\u660e\u5929\u5462\u6211\u4eec"), (None, None)], "item_id bigint, text string")
    texts = ["so: what is two plus two?", "what is two plus twos? yes", "two plus sixty", "(TWO plus\nsix)", "a what is two plus two", "\u597d" + "\u4eca\u5929\u5929\u6c14\u600e\u4e48\u6837\u660e\u5929\u5462\u6211\u4eec" + "\u597d", "two plus sixty two plus six", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = sorted((r.doc_id, r.item_id, r.distance, r.start_char, r.end_char) for r in edit_matching.matches(docs, benchmark).collect())
    assert found == [(0, 1, 0, 4, 25), (3, 3, 0, 1, 13), (5, 4, 0, 1, 13), (6, 3, 0, 15, 27)]
    assert {r.doc_id for r in edit_matching.keep_clean(docs, benchmark).collect()} == {1, 2, 4, 7, 8}


def test_chains_are_best_collinear_ones():
    assert passage_chains.chains([(0, 10, 0, 10), (12, 30, 11, 29)]) == [(0, 30, 0, 29)]
    # crossing runs never share a chain
    assert sorted(passage_chains.chains([(0, 20, 50, 70), (30, 60, 0, 30)])) == [(0, 20, 50, 70), (30, 60, 0, 30)]
    # a gap that costs more than the chain is worth is not bridged
    assert len(passage_chains.chains([(0, 10, 0, 10), (60, 70, 60, 70)])) == 2


def test_chain_scores_equal_a_quadratic_version():
    rng = random.Random(4)
    for _ in range(100):
        segments = sorted({(s, s + rng.randint(5, 20), o, o + rng.randint(5, 20)) for s, o in ((rng.randint(0, 100), rng.randint(0, 100)) for _ in range(12))})
        score = []
        for i, (s, e, o, _) in enumerate(segments):
            prior = [score[j] - 2 * (s - segments[j][1] + o - segments[j][3]) for j in range(i) if segments[j][1] <= s and segments[j][3] <= o]
            score.append(e - s + max([0, *prior]))
        best = segments[max(range(len(segments)), key=lambda i: (score[i], -i))]
        found = passage_chains.chains(segments)[0]
        assert found[1] == best[1] and found[3] == best[3]


def test_common_length():
    rng = random.Random(6)
    for _ in range(50):
        a, b = rng.choices("abcd", k=rng.randint(0, 30)), rng.choices("abcd", k=rng.randint(1, 30))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(row[j] + (x == y), row[j + 1], new[j]))
            row = new
        assert passage_chains.common_length(a, b) == row[-1]


def test_repeated_passages(spark):
    rng = random.Random(7)
    passage = sentence(rng, 70).split()
    edited = list(passage)
    edited[30] = "changed"
    texts = [sentence(rng, 150) for _ in range(30)]
    for i, words in ((3, passage), (9, passage), (21, edited), (25, passage[:20])):
        texts[i] = texts[i] + " " + " ".join(words) + " " + sentence(rng, 20)
    texts += [texts[5], None, "", "a b"]
    rows = passage_chains.repeated_passages(frame(spark, texts)).collect()
    assert {(r.doc_id, r.other_id) for r in rows} == {(9, 3), (21, 3), (30, 5)}
    assert all(r.similarity >= 0.8 for r in rows)
    nine = next(r for r in rows if r.doc_id == 9)
    assert (nine.span_start, nine.span_end, nine.other_start) == (150, 220, 150)
    odd = odd_rows(spark)
    assert passage_chains.repeated_passages(odd).count() == 0
    assert passage_chains.repeated_passages(odd.where("false")).count() == 0


def test_pieces_of_a_passage_from_several_documents_join(spark):
    rng = random.Random(11)
    passage = sentence(rng, 80).split()
    texts = [sentence(rng, 60) + " " + " ".join(passage[:40]), sentence(rng, 60) + " " + " ".join(passage[40:]), sentence(rng, 60) + " " + " ".join(passage)]
    rows = passage_chains.repeated_passages(frame(spark, texts)).collect()
    assert {(r.doc_id, r.other_id) for r in rows} == {(2, 0), (2, 1)}
    assert {(r.span_start, r.span_end) for r in rows} == {(60, 140)}


def test_copies_inside_one_document_are_found_in_any_partitioning(spark):
    rng = random.Random(12)
    passage = sentence(rng, 60)
    texts = [sentence(rng, 30) + " " + passage, sentence(rng, 100), " ".join([sentence(rng, 40), passage, sentence(rng, 40), passage]), sentence(rng, 80)]
    for parts in (1, 4):
        rows = passage_chains.repeated_passages(frame(spark, texts).repartitionByRange(parts, "doc_id")).collect()
        assert {(r.doc_id, r.span_start, r.span_end) for r in rows} == {(2, 40, 100), (2, 140, 200)}, parts


def test_verbatim_passages_with_words_inserted_between_them():
    rng = random.Random(13)
    for _ in range(30):
        passages = [sentence(rng, 200).split() for _ in range(4)]
        mine = [w for p in passages for w in p]
        theirs, members = [], []
        for i, p in enumerate(passages):
            members.append((200 * i, 200 * i + 200, len(theirs), len(theirs) + 200))
            theirs += p + sentence(rng, 75).split()
        found = passage_chains.aligned_parts(mine, theirs, members)
        assert sum(min(e, 800) - s for s, e, *_ in found) >= 795 and all(f[4] >= 0.8 for f in found)
    assert passage_chains.chained_runs([(0, 10, 0, 10), (12, 30, 11, 29)]) == [[(0, 10, 0, 10), (12, 30, 11, 29)]]


def test_inserted_text_does_not_lose_the_passages_around_it(spark):
    rng = random.Random(14)
    passages = [sentence(rng, 200) for _ in range(4)]
    texts = [" ".join(p + " " + sentence(rng, 75) for p in passages), " ".join(passages)] + [sentence(rng, 50) for _ in range(3)]
    rows = passage_chains.repeated_passages(frame(spark, texts)).collect()
    assert {r.doc_id for r in rows} == {1} and max(r.span_end - r.span_start for r in rows) >= 795


def test_a_passage_whose_seeds_all_occur_by_chance_before(spark):
    rng = random.Random(15)
    passage = sentence(rng, 60).split()
    # unrelated documents that hold every five-word window of the passage, but no more of it at a time
    chance = [" ".join(sentence(rng, 12) + " " + " ".join(passage[i : i + 5]) for i in range(at, 56, 8)) + " " + sentence(rng, 12) for at in range(8)]
    texts = [*chance, sentence(rng, 40) + " " + " ".join(passage) + " " + sentence(rng, 40), sentence(rng, 70) + " " + " ".join(passage) + " " + sentence(rng, 10)]
    for parts in (1, 5):
        rows = passage_chains.repeated_passages(frame(spark, texts).repartitionByRange(parts, "doc_id")).collect()
        assert {(r.doc_id, r.other_id) for r in rows} == {(9, 8)}, parts
        assert min(r.span_start for r in rows) <= 75 and max(r.span_end for r in rows) >= 125


def test_seeds_of_texts_together_are_those_of_each_alone():
    """Texts behind one another share numpy calls, never a window; their words are those of words_of, their hashes XXH64."""
    rng = random.Random(7)
    texts = ["", None, "a b c", "a b c d e", "  A B\x0b\x0cc D e f \x1c g h i j k l m n o \n", "x " * 100, " ", " ".join("q" * i for i in range(70))]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 40) for _ in range(rng.randrange(60))) for _ in range(40)]
    column = pa.array(["dropped", *texts], pa.string()).slice(1)
    codes, sizes = passage_chains.word_codes(column)
    words = [passage_chains.words_of((t or "").encode()) for t in texts]
    assert sizes.tolist() == [len(w) for w in words]
    assert codes.tolist() == [xxhash.xxh64_intdigest(w) for text in words for w in text]
    together = list(zip(*(c.tolist() for c in passage_chains.seeds_of(codes, sizes)), strict=True))
    for i in range(len(texts)):
        alone = passage_chains.seeds_of(*passage_chains.word_codes(column.slice(i, 1)))
        assert [s[:3] for s in together if s[3] == i] == [s[:3] for s in zip(*(c.tolist() for c in alone), strict=True)]


def test_common_length_with_equal_ends():
    assert passage_chains.common_length(list("abcxde"), list("abcyyde")) == 5
    assert passage_chains.common_length(list("aaa"), list("aaaaa")) == 3
    assert passage_chains.common_length(list("abab"), list("ba")) == 2
    assert passage_chains.common_length([], list("a")) == 0


def edited_every(rng, words, k):
    return [w if (i + 1) % k else f"new{rng.randrange(10**9)}" for i, w in enumerate(words)]


def test_passages_with_an_edit_in_every_six_words(spark):
    """The five equal words between two edits are one window: every window has to be a seed."""
    rng = random.Random(16)
    passages = [sentence(rng, 100).split() for _ in range(12)]
    wrapped = lambda words: " ".join([sentence(rng, 80), *words, sentence(rng, 80)])
    texts = [wrapped(p) for p in passages] + [wrapped(edited_every(rng, p, 6)) for p in passages]
    rows = passage_chains.repeated_passages(frame(spark, texts)).collect()
    spans = {(r.doc_id, r.span_start, r.span_end) for r in rows}
    assert {d for d, *_ in spans} == set(range(12, 24)) and {(r.doc_id, r.other_id) for r in rows} == {(12 + i, i) for i in range(12)}
    assert sum(max(0, min(e, 180) - max(s, 80)) for _, s, e in spans) >= 0.9 * 12 * 100


def test_an_edited_passage_whose_windows_all_occur_before(spark):
    """No sixteen words are equal; every window of five comes before in unrelated documents, once or in more than MEET places."""
    rng = random.Random(17)
    passage = sentence(rng, 100).split()
    for times in (1, 3 * passage_chains.MEET):
        chance = [" ".join(sentence(rng, 12) + " " + " ".join(passage[i : i + 5]) for i in range(at, 96, 8)) + " " + sentence(rng, 12) for at in range(8) for _ in range(times)]
        texts = [*chance, " ".join([sentence(rng, 40), *passage, sentence(rng, 40)]), " ".join([sentence(rng, 70), *edited_every(rng, passage, 12), sentence(rng, 10)])]
        n = len(chance)
        rows = passage_chains.repeated_passages(frame(spark, texts).coalesce(1)).collect()
        assert {(r.doc_id, r.other_id) for r in rows} == {(n + 1, n)}, times
        assert min(r.span_start for r in rows) <= 75 and max(r.span_end for r in rows) >= 160


def test_met_places_equal_a_plain_version():
    rng = np.random.default_rng(3)
    for spread in (3, 40, 400):
        keys, docs = rng.integers(0, spread, 600).astype(np.uint64), rng.integers(0, 30, 600)
        pos = rng.permutation(600).astype(np.int32)
        mine, theirs, many, first = passage_chains.met(keys, docs, pos)
        expected, hot = set(), set()
        for key in set(keys.tolist()):
            places = sorted(np.flatnonzero(keys == key).tolist(), key=lambda i: (docs[i], pos[i]))
            few = len(places) <= passage_chains.MEET
            expected |= {(a, b) for j, a in enumerate(places) for b in (places[:j] if few else places[:1]) if docs[a] != docs[b]}
            hot |= set() if few or len(set(docs[places].tolist())) == 1 else {(a, places[0]) for a in places}
        assert sorted(zip(mine.tolist(), theirs.tolist(), strict=True)) == sorted(expected)
        assert sorted(zip(many.tolist(), first.tolist(), strict=True)) == sorted(hot)


def test_packed_seeds_come_back():
    rng = np.random.default_rng(4)
    keys, docs = rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2), np.sort(rng.integers(-(1 << 60), 1 << 60, 5000))
    pos, near = rng.integers(0, 1 << 30, 5000).astype(np.int32), rng.integers(0, 1 << 32, 5000).astype(np.uint32)
    last = pos + rng.integers(0, 8, 5000).astype(np.int32)
    packed = passage_chains.packed_seeds(keys, docs, pos, last, near, 7)
    back = passage_chains.unpacked_seeds(iter([packed.slice(0, 3), packed.slice(3)]))
    mask = np.uint64((1 << 40) - 1)
    assert sorted(zip(*(c.tolist() for c in back), strict=True)) == sorted(zip(*(c.tolist() for c in (keys & mask, docs, pos, last, near)), strict=True))
    assert all(len(c) == 0 for c in passage_chains.unpacked_seeds(iter([])))


def test_one_word_repeated_where_many_documents_repeat_it_less_often(spark):
    """Keys of one and of two seeds are of many places, and the first place of each makes no chain."""
    rng = random.Random(18)
    texts = [" ".join([sentence(rng, 20), *["word"] * n, sentence(rng, 20)]) for n in [5 + i % 7 for i in range(60)] + [70, 70]]
    rows = passage_chains.repeated_passages(frame(spark, texts)).collect()
    assert {(r.doc_id, r.other_id) for r in rows} == {(61, 60)}
    assert min(r.span_start for r in rows) <= 20 and max(r.span_end for r in rows) >= 90
