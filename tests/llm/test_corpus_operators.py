"""Joins, language model, vectors, classifiers and the pipeline against brute force or held-out labels."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from obslake.llm import class_lm, embedding_dedup, nbsvm, ngram_join, toxicity
from obslake.llm.common import components


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def links_of(rows):
    found, lists = [], {}
    for i, (_, s) in enumerate(rows):
        shared = Counter(j for x in s for j in lists.get(x, ()))
        found += [(i, j) for j, n in shared.items() if 100 * n >= 80 * (len(s) + len(rows[j][1]) - n)]
        for x in s:
            lists.setdefault(x, []).append(i)
    return found


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(i, i + 1) for i in range(400, 440)] + [(500, 500)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [x for x in links if x[0] != x[1]]
    assert got == roots({n for x in links for n in x}, links)


def test_ngram_join_equals_brute_force(some_docs, docs_of):
    rows = [(r["doc_id"], shingles(r["text"])) for r in some_docs.where("doc_id is not null").collect()]
    base = [f"w{i}" for i in range(120)]
    for k in range(40):  # a group of different texts, each a few words from one base
        words = list(base)
        for j in range(k % 5):
            words[(k * 17 + j * 29) % 120] = f"x{k}n{j}"
        rows.append((800_000 + k, " ".join(words)))
    extra = docs_of([x for x in rows if isinstance(x[1], str)])
    rows = [(i, shingles(x) if isinstance(x, str) else x) for i, x in rows]
    docs = some_docs.where("doc_id is not null").union(extra.select("doc_id", "text"))
    got = sorted(tuple(r) for r in ngram_join.link_components(docs, hubs=1, star_rounds=1).collect())
    by_id = roots({i for i, _ in rows}, [(rows[a][0], rows[b][0]) for a, b in links_of(rows)])
    assert got == sorted((i, len(s), by_id[i]) for i, s in rows)


@pytest.mark.parametrize("orders", [1, 2, 4])
def test_ngram_join_finds_every_link_between_texts(docs_of, orders):
    rng = np.random.default_rng(orders)
    rows = []
    for group, (size, words) in enumerate([(25, 160), (15, 400), (20, 60), (10, 6)]):
        base = [f"g{group}w{i}" for i in range(words)]
        for _ in range(size):  # from one changed word to so many that the pair is unlike
            text = list(base)
            for at in rng.integers(0, words, rng.integers(1, max(2, words // 50) + 1)):
                text[at] = f"x{rng.integers(1 << 40)}"
            rows.append((len(rows), " ".join(text)))
    shared = " ".join(f"passage{i}" for i in range(60))
    rows += [(500 + k, " ".join(f"d{k}w{i}" for i in range(60 + 5 * k)) + " " + shared) for k in range(30)]
    rows += [(900, rows[3][1].upper()), (901, rows[3][1]), (902, None), (903, ""), (904, "two words"), (904, "two  words")]
    links, members = ngram_join.similar_classes(docs_of(rows), orders=orders)
    ids = {}
    for r in members.collect():
        ids.setdefault(r["class"], []).append(r["doc_id"])
    got = [(r["a"], r["b"]) for r in links.collect()]
    assert len(got) == len(set(got)) and all(a < b for a, b in got)
    first = {min(x): c for c, x in ids.items() if c is not None}
    assert sorted(ids[None]) == [902, 903] and sorted(ids[first[3]]) == [3, 900, 901] and ids[first[904]] == [904, 904]
    texts = [(i, shingles(t)) for i, t in rows if i in first and t][:len(first)]
    want = {tuple(sorted((first[texts[a][0]], first[texts[b][0]]))) for a, b in links_of(texts)}
    assert len(want) > 100 and set(got) == want


def test_ngram_join_of_an_empty_table(docs_of):
    docs = docs_of([(1, "a")]).where("doc_id < 0")
    assert ngram_join.link_components(docs).count() == 0 and ngram_join.representatives(docs).count() == 0
    assert [x.count() for x in ngram_join.similar_classes(docs)] == [0, 0]


def test_representatives_keep_one_row_of_each_group(docs_of):
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdefg"}
    near = text["a"].replace("a59", "x")
    rows = [(None, text["a"]), (None, text["b"]), (None, text["b"]), (7, text["c"]), (7, text["d"]), (7, text["d"]), (3, near),
            (9, text["e"]), (None, text["e"]), (9, text["e"].upper()), (8, text["f"]), (5, text["f"]), (11, ""), (11, ""), (12, None), (7, " "),
            (None, ""), (None, None)]
    docs = docs_of(rows)
    got = ngram_join.representatives(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    got = sorted(((r["doc_id"], (r["text"] or "").strip().lower()) for r in got.collect()), key=str)
    want = [(3, near), (None, text["b"]), (7, text["c"]), (7, text["d"]), (9, text["e"]), (5, text["f"]), (11, ""), (12, ""), (7, ""),
            (None, ""), (None, "")]
    assert got == sorted(want, key=str)


def test_representatives_send_texts_once(docs_of, plan):
    rows = [(1, "one two three"), (1, "one two three"), (None, "four five"), (None, "four five"), (0, "four five"), (0, "six"), (None, "six")]
    got = ngram_join.representatives(docs_of(rows))
    text = plan(got)
    assert "Exchange" not in text[:text.index("LeftSemi")]  # the join and the rank share one exchange, which is below both
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(0, "four five"), (0, "six"), (1, "one two three")]


def test_class_lm_baseline_and_proper_model(some_docs):
    rows = [(r["doc_id"], [*(r["text"] or "").encode().lower().split(), None]) for r in some_docs.where("doc_id is not null").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, ws in rows if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    got = class_lm.score(some_docs.where("doc_id is not null"), clustered=64, classes=8, sent=200).collect()
    want = sorted((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 5)) for i, ws in rows)
    assert sorted((*tuple(r)[:5], round(r["base_score"], 5)) for r in got) == want
    assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])


def test_class_lm_gives_every_learning_word_a_class(docs_of):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        nouns, verbs = rng.integers(0, 150, 6), rng.integers(0, 150, 6)
        rows.append((i, " ".join(f"the noun{a} verb{b} well" for a, b in zip(nouns, verbs))))
    held = [i for i in range(10_000, 11_000) if zlib.crc32(str(i).encode()) % 7 == 2][:40]
    for i, k in zip(held[::2], range(20)):
        rows += [(i, f"the noun{k} verb{k} well"), (held[held.index(i) + 1], f"the verb{k} noun{k} well")]
    rows += [(None, "never seen " * 3), (20_000, "x" * 70 + " noun1"), (20_001, None)]
    docs = docs_of(rows)
    few, many = ({r["doc_id"]: r for r in class_lm.score(docs, clustered=60, classes=6, sent=sent).collect()} for sent in (80, 10_000))
    assert all(few[held[2 * k]]["score"] > few[held[2 * k + 1]]["score"] + 1 for k in range(20))
    assert few.keys() == many.keys() and all(tuple(few[i])[:5] == tuple(many[i])[:5] for i in few)
    assert all(math.isclose(few[i][c], many[i][c], abs_tol=1e-6) for i in few for c in ("base_score", "score"))


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(2)
    steps = rng.poisson(1, (32, 32)) + 40 * (np.arange(32)[:, None] // 8 == (np.arange(32)[None, :] // 8 + 1) % 4)

    def likelihood(of):
        table = np.zeros((6, 6))
        np.add.at(table, (of[:, None], of[None, :]), steps.astype(float))
        f = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
        return f(table) - f(table.sum(0)) - f(table.sum(1))

    of = class_lm.exchange(steps, 4)
    assert set(of[:30]) <= set(range(4)) and of[30] == 4 and of[31] == 5
    assert likelihood(of) > likelihood(np.concatenate([np.arange(30) % 4, [4, 5]]))


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((20, 16))
    rows = [(i, (base[i % 20] + 0.12 * rng.standard_normal(16)).astype(float).tolist(), i % 2) for i in range(160)]
    rows += [(200 + i, rows[0][1], 0) for i in range(5)] + [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0),
             (303, [None] * 16, 0), (304, rows[1][1], None), (305, [1.0, 2.0], 0), (306, [], 0), (307, [-1e300] * 16, 1), (308, [-1e-300] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit("x")).withColumn("class", F.lit(1))
    got = sorted(tuple(r) for r in embedding_dedup.link_vectors(df, block=8).collect())
    fit = [(i, np.array(v) / np.abs(v).max(), y) for i, v, y in rows if y is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = [(i, j) for i, v, y in fit for j, w, z in fit if i < j and y == z and len(v) == len(w)
             and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93]
    n, root = Counter(x for link in links for x in link), roots({r[0] for r in rows}, links)
    assert got == sorted((i, n[i], root[i], root[i] == i) for i, _, _ in rows)
    assert embedding_dedup.link_vectors(df.where("vec_id < 0")).count() == 0


def test_vectors_without_or_with_shared_ids(spark):
    a, b, c = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    near_a, near_b = [1.0, 0.01, 0.0, 0.0], [0.0, 1.0, 0.01, 0.0]
    rows = [(None, a, 0), (None, near_a, 0), (None, c, 1), (4, c, 1),  # ids that are null
            (5, a, 2), (5, b, 3), (6, near_a, 2), (7, near_b, 3), (8, b, 3),  # an id with two labels
            (9, a, 4), (9, b, 4), (10, near_b, 4)]  # an id with two vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.link_vectors(df).collect())
    assert got == Counter([(None, 1, None, True), (None, 1, None, True), (None, 1, 4, False), (4, 1, 4, True),
                           (5, 1, 5, True), (6, 1, 5, False), (5, 2, 5, True), (7, 2, 5, False), (8, 2, 5, False),
                           (9, 0, 9, True), (9, 1, 9, True), (10, 1, 9, False)])


@pytest.mark.parametrize("operator, label, modulus, remainder", [(nbsvm, "quality", 5, 0), (toxicity, "toxic", 4, 2)])
def test_classifiers_on_held_out_rows(spark, operator, label, modulus, remainder):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    model = operator.train(docs, labels)
    got = {r["doc_id"]: r for r in operator.score(docs, model).collect()}
    held = [(got[r["doc_id"]]["score"], r[label]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder]
    ones, zeros = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / len(ones) / len(zeros)
    assert len(got) == docs.count() and auc > (0.97 if label == "quality" else 0.8)
    odd = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "word " * 50_000)], "doc_id long, text string")
    assert all(0 <= r["score"] <= 1 for r in operator.score(odd, model).collect())
    one_class = operator.train(docs, labels.where(F.col(label) == 0))
    assert operator.score(odd, one_class).where("predicted = 1").count() == 0


def test_quality_without_labels_or_rows(spark, docs_of):
    docs = docs_of([(1, "a b c"), (1, "a b c"), (2, None), (None, ""), (5, "d " * 60)])
    labels = spark.createDataFrame([(2, None), (None, 1), (99, 1)], "doc_id long, quality int")
    for some in (labels, labels.where("quality = 7")):
        model = nbsvm.train(docs, some)
        assert {r["score"] for r in nbsvm.score(docs, model).collect()} == {0.5} and nbsvm.keep(docs, model).count() == 5
    none = docs.where("doc_id < 0")
    model = nbsvm.train(none, labels)
    assert nbsvm.score(none, model).count() == 0 and nbsvm.keep(none, model).columns == docs.columns


def test_toxic_spans_are_offsets():
    field = toxicity.Field({"=nasty": 9.0}, -5.0, np.zeros((2, 2)))
    score, spans = toxicity.Scorer(field).score("A calm start. Some nasty, words.")
    assert score > 0.9 and [(a, b) for a, b, _ in spans] == [(19, 25)]


def test_field_without_toxic_rows(docs_of):
    docs = docs_of([(i, f"calm words number {i} in a row. " * 40) for i in range(60)] + [(100, None), (101, "")])
    empty = docs.sparkSession.createDataFrame([], "doc_id long, toxic int")
    clean = docs.select("doc_id", F.lit(0).alias("toxic"))
    for labels in (empty, clean):
        got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
        assert len(got) == 62 and all(r["score"] < toxicity.FLOOR and r["predicted"] == 0 for r in got)


def test_length_alone_raises_no_score():
    field = toxicity.Field({"=nasty": 9.0}, -2.0, np.zeros((2, 2)))  # a bias above the floor, as of few labels
    scorer = toxicity.Scorer(field)
    assert scorer.score("calm words here. " * 5_000)[0] < toxicity.FLOOR
    assert scorer.score("calm words here. " * 5_000 + "Some nasty words.")[0] > 0.9


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    on, size, step = rng.normal(size=(3, 5)), np.array([5, 3, 1]), rng.normal(size=(2, 2))
    chance, steps = toxicity.marginals(on, size, step)
    for r in range(3):
        total, want, moves = 0.0, np.zeros(5), np.zeros(4)
        for code in range(2 ** size[r]):
            y = [code >> t & 1 for t in range(size[r])]
            weight = math.exp(sum(on[r, t] for t in range(size[r]) if y[t]) + sum(step[a, b] for a, b in zip(y, y[1:])))
            total += weight
            want[:size[r]] += weight * np.array(y)
            for a, b in zip(y, y[1:]):
                moves[2 * a + b] += weight
        assert np.allclose(chance[r], want / total) and np.allclose(steps[r], moves / total)


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("kept", F.lit(1))
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs_out = stage(spark, docs, sf)
        assert docs_out.columns == docs.columns
        docs_out = spark.createDataFrame(docs_out.collect(), docs.schema)
        seen[name] = {r["doc_id"]: r["text"] for r in docs_out.collect()}
        docs = docs_out
    rules, joined = seen["quality_rules"], seen["ngram_join"]
    rows = [(i, shingles(t)) for i, t in sorted(rules.items())]
    of = roots(set(rules), [(rows[a][0], rows[b][0]) for a, b in links_of(rows)])
    assert set(joined) == {i for i in rules if of[i] == i}
    packed = corpus_pipeline.STAGES[3][1](spark, docs, sf)
    assert {r["doc_id"] for r in packed.collect()} == set(joined)


def test_pipeline_on_awkward_rows_and_none(spark, docs_of, tmp_path):
    text = {c: " ".join(f"{c}{i}" for i in range(70)) + "." for c in "abc"}
    rows = [(1, text["a"]), (1, text["a"]), (2, text["a"].upper()), (None, text["b"]), (None, text["c"]), (3, None), (4, ""), (5, "few words")]
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for name, docs, want in (("some", docs_of(rows), [(None, 70), (None, 70), (1, 70)]), ("none", docs_of(rows).where("doc_id < 0"), [])):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert sorted((r["doc_id"] or 0 for r in got)) == sorted(i or 0 for i, _ in want) and all(r["length"] > 70 for r in got)
