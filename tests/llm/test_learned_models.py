"""Language models, quality trees and the URL graph."""

import random

import duckdb
import numpy as np
import pytest

from sitewarden.llm import language_kn, quality_trees, url_graph

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string"


def letters(lang, rng, n):
    stems = {"xx": ["ba", "ke", "lo", "mi"], "yy": ["str", "ong", "ith", "üm"]}[lang]
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows(rng, n):
    return [(i, letters(lang, rng, rng.randint(3, 60)), lang, "s") for i in range(n) for lang in [rng.choice(["xx", "yy"])]]


def test_kneser_ney_is_a_distribution_and_matches_a_plain_version(spark):
    rng = random.Random(1)
    data = rows(rng, 120)
    docs = spark.createDataFrame(data, SCHEMA)
    model = language_kn.fit(docs, docs, min_share=1e-9)
    counts = {}
    for _, text, lang, _ in data:
        padded = "   " + text + " "
        for i in range(3, len(padded)):
            key = (lang, padded[i - 3 : i + 1])
            counts[key] = counts.get(key, 0) + 1
    tables = {4: counts}
    for k in (3, 2, 1):
        tables[k] = {}
        for lang, gram in tables[k + 1]:
            tables[k][lang, gram[1:]] = tables[k].get((lang, gram[1:]), 0) + 1

    def cut(k, lang):
        n1 = sum(1 for (g, _), n in tables[k].items() if g == lang and n == 1)
        n2 = sum(1 for (g, _), n in tables[k].items() if g == lang and n == 2)
        return min(0.95, n1 / (n1 + 2 * n2)) if n1 else 0.5

    cuts = {(k, lang): cut(k, lang) for k in tables for lang in ("xx", "yy")}

    def p(gram, lang):
        k = len(gram)
        if k == 0:
            return 1 / language_kn.SYMBOLS
        inside = {g: n for (own, g), n in tables[k].items() if own == lang and g[:-1] == gram[:-1]}
        total = sum(inside.values())
        if not total:
            return p(gram[1:], lang)
        d = cuts[k, lang]
        alphas = {g: max(n - d, 0) / total for g, n in inside.items()}
        return alphas.get(gram, 0) + (1 - sum(alphas.values())) * p(gram[1:], lang)

    text = "bake strong loq mi"
    padded = "   " + text + " "
    _, found = model.cross_entropies([text.encode()])
    for i, lang in enumerate(model.languages):
        expected = -np.mean([np.log(p(padded[j - 3 : j + 1].replace("", ""), lang)) for j in range(3, len(padded))])
        assert found[0, i] == pytest.approx(expected, rel=1e-4)


def test_language_of_odd_rows(spark):
    rng = random.Random(2)
    model = language_kn.fit_documents(spark.createDataFrame(rows(rng, 300), SCHEMA))
    odd = [(1, None, "xx", None), (2, "", None, None), (3, "123 !!", "q", None), (None, letters("yy", rng, 20), None, None), (4, letters("xx", rng, 90_000), None, None), (4, letters("xx", rng, 5), "yy", None), (5, "слова совсем другого языка " * 20, "xx", None)]
    docs = spark.createDataFrame([(*r, 1.5, "z") for r in odd], SCHEMA + ", score double, rejected string")
    found = [r.asDict() for r in language_kn.judge(docs, model, "doc_id").collect()]
    assert [r["lang_pred"] for r in found[:6]] == ["und", "und", "und", "yy", "xx", "xx"]
    assert all(0 <= r["score"] <= 1 for r in found)
    assert [r["rejected"] for r in found] == [True, True, True, False, False, False, True]
    kept = language_kn.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == 3
    empty = language_kn.fit_documents(docs.where("false"))
    assert {r.lang_pred for r in language_kn.judge(docs, empty, "doc_id").collect()} == {"und"}
    assert language_kn.keep_identified(docs.where("false"), model).count() == 0


def test_language_accuracy_on_held_out_documents(spark):
    from sitewarden.llm.queries import QUERIES

    found = QUERIES["op8_language_kn"](spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").collect()
    assert len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert found.where("rejected").count() < 20


def test_repeated_words_equal_a_plain_version():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.3:
            words = [str(i).encode() for i in range(5000)] + words * 2
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        seen = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
        assert quality_trees.repeated_words(words) == len(covered)


def test_statistics_of_a_text():
    counts, _ = quality_trees.statistics("Ünï $x\n\t\nÜnï $x\n".encode())
    assert counts == [4, 10, 2, 1, 0]
    assert quality_trees.statistics(b"")[0] == [0, 0, 0, 0, 0]


def test_trees_learn_and_respect_the_constraints():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 9))
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.7)).astype(float)
    forest = quality_trees.grow(x, y)
    fresh = rng.random((1000, 9))
    truth = (fresh[:, 0] > 0.5) & (fresh[:, 2] < 0.7)
    assert ((forest.margin(fresh) > 0) == truth).mean() > 0.95
    noisy = quality_trees.grow(x, rng.integers(0, 2, 3000).astype(float))
    for f in np.flatnonzero(quality_trees.MONOTONE):
        for model in (forest, noisy):
            low, high = fresh.copy(), fresh.copy()
            high[:, f] += rng.random(1000)
            assert (model.margin(high) <= model.margin(low) + 1e-9).all()


def test_quality_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    forest = quality_trees.fit(docs, labels.where("doc_id % 3 <> 0"))
    found = quality_trees.judge(docs, forest).join(labels.where("doc_id % 3 = 0"), "doc_id").where("not base_failed").collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert sum(r.kept == bool(truth[r.doc_id]) for r in found) / len(found) > 0.95


def test_quality_of_odd_rows(spark):
    odd = [(1, None, 0), (1, "", 0), (None, "word " * 9, 0), (2, "one two three four five six seven eight nine ten", 0), (3, "a b c d e f " * 20_000, 0)]
    docs = spark.createDataFrame(odd, "doc_id bigint, text string, quality int")
    labels = spark.createDataFrame([(2, None), (None, 1), (2, 7)], "doc_id bigint, quality int")
    forest = quality_trees.fit(docs, labels)
    assert forest is None
    assert [r.kept for r in quality_trees.judge(docs, forest).collect()] == [False, False, False, True, False]
    assert quality_trees.judge(docs.where("false"), forest).count() == 0


def pages(spark, data):
    return spark.createDataFrame([(*r, "h", 1) for r in data], "page_id bigint, url string, html string, host string, verdict int")


def test_hosts_paths_and_rules(spark):
    data = [(1, "http://A.Example.NET/en/x?y", ""), (2, "https://example.net#t", ""), (3, "ftp://x.example.com/de/", None), (4, "nothing", None), (5, None, None), (6, "http://a.b.org/fr/1/2#z", ""), (6, "a://notexample.com/de/", ""), (7, "http://net/p?q", "")]
    found = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_graph.judge(pages(spark, data)).orderBy("page_id", "host").collect()]
    assert found == [
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "example.net", "", None, "allow"),
        (3, "x.example.com", "/de/", "example.com/de/", "block"),
        (4, "", "", None, "allow"),
        (5, "", "", None, "allow"),
        (6, "a.b.org", "/fr/1/2", "org/fr/", "allow"),
        (6, "notexample.com", "/de/", None, "allow"),
        (7, "net", "/p", "net/", "block"),
    ]
    assert url_graph.judge(pages(spark, data).where("false")).count() == 0


def test_pagerank_equals_power_iteration(spark):
    rng = random.Random(4)
    names = [f"h{i}" for i in range(12)]
    edges = {(rng.choice(names), rng.choice(names)): float(rng.randint(1, 3)) for _ in range(30)}
    edges = {k: n for k, n in edges.items() if k[0] != k[1]}
    seeds = {"h1": 0.5, "h2": 0.25}
    ranks = dict(seeds)
    for _ in range(300):
        new = dict.fromkeys(names, 0.0)
        stuck = 0.0
        for h, r in ranks.items():
            out = {d: n for (s, d), n in edges.items() if s == h}
            if not out:
                stuck += r
            for d, n in out.items():
                new[d] += 0.85 * r * n / sum(out.values())
        for h, s in seeds.items():
            new[h] += s * (0.15 + 0.85 * stuck / 0.75)
        ranks = new
    found = url_graph.spread(spark.createDataFrame([(s, d, n) for (s, d), n in edges.items()], "src string, dst string, n double"), spark.createDataFrame(list(seeds.items()), "host string, seed double"))
    found = {r.host: r.score for r in found.collect()}
    assert all(found.get(h, 0.0) == pytest.approx(r, abs=1e-5) for h, r in ranks.items())
    assert sum(found.values()) == pytest.approx(0.75)


def test_trust_reaches_the_end_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1.0) for i in range(40)], "src string, dst string, n double")
    found = {r.host: r.score for r in url_graph.spread(edges, spark.createDataFrame([("h0", 1.0)], "host string, seed double")).collect()}
    whole = sum(0.85**i for i in range(41))
    assert all(found[f"h{i}"] == pytest.approx(0.85**i / whole, abs=1e-5) for i in range(41))


def test_distrust_flows_back_along_links(spark):
    link = '<a href="http://{}/p">x</a>'
    data = [(i, "http://bad.net/p", "") for i in range(6)]
    data += [(10, "http://friend.com/p", link.format("Bad.NET") * 3), (11, "http://good.com/p", link.format("trusted.org")), (12, "http://trusted.org/fr/", link.format("endorsed.com") + link.format("bad.net")), (13, "http://endorsed.com/", "<a href=/local>")]
    found = {r.host: r.verdict for r in url_graph.judge(pages(spark, data)).collect()}
    assert found == {"bad.net": "block", "friend.com": "block", "good.com": "allow", "trusted.org": "allow", "endorsed.com": "allow"}


def test_rules_equal_sql(spark):
    from sitewarden.llm.queries import QUERIES

    sql = """
    SELECT page_id, lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS path FROM pages
    """
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{DATA}/pages.parquet'")
    found = {(r.page_id, r.host, r.path) for r in QUERIES["op1_url_graph"](spark, DATA).collect()}
    assert found == set(con.execute(sql).fetchall())
