"""Token alignment, vantage-point search and phrase mining against plain loops and DuckDB."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from obslake.llm import phrase_mining, queries, token_alignment, vantage_search
from obslake.llm.oracle import phrase_mining_sql

PATHS = (queries.vocabulary(), queries.vocabulary("piece_bpe_32k.model"))


# --- token alignment ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def groups_of(text, libraries):
    """[(A ids, B ids)] cut where tokens of both end, or none."""
    if not text:
        return []
    enc = token_alignment.tokenizers(*PATHS)
    a = libraries[0].encode(" " + text, add_special_tokens=False).ids
    b = libraries[1].encode(text)
    if any(b"".join(of[i] for i in ids) != (" " + text).encode() for of, ids in ((enc.bytes_a, a), (enc.bytes_b, b))):
        return []
    ends = [list(itertools.accumulate(len(of[i]) for i in ids)) for of, ids in ((enc.bytes_a, a), (enc.bytes_b, b))]
    out, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        x, y = ends[0].index(cut) + 1, ends[1].index(cut) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


def digests(rows, libraries):
    groups = [groups_of(text, libraries) for _, text in rows]
    links = [Counter(p for a, b in g for p in itertools.product(a, b)) for g in groups]
    docs = Counter(p for of in links for p in of)
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, _), g, of in zip(rows, groups, links):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(of.values()),
                    sum(n for p, n in of.items() if docs[p] == best[p[0]]), sum(n * docs[p] for p, n in of.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return out


def odd_texts():
    rng = random.Random(5)
    parts = ["word", "Über", "日本語", " ", "  ", "\n", "\t", " ", "▁", "<s>", "<0x41>", "<|endoftext|>", "don't", "12345", "...", "é", "é", "\x00", "\x85",
             "😀", "naïve", "xxxxxxxxxxxx", "　", "\x1c"]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(1, 40))) for _ in range(300)]


def test_words_encode_like_the_whole_text(libraries):
    enc = token_alignment.tokenizers(*PATHS)
    texts = odd_texts()
    for text, words in [*zip(texts, enc.words(texts)), *((t, enc.words([t])[0]) for t in texts)]:
        assert np.frombuffer(b"".join(w[0] for w in words), "<u4").tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
        if token_alignment.BLANK in text:  # B takes it for a blank: no tokens, however they are cut
            assert not all(w[2] for w in words)
        else:
            assert np.frombuffer(b"".join(w[1] for w in words), "<u4").tolist() == libraries[1].encode(text) and all(w[2] for w in words)


def test_alignment_equals_brute_force(some_docs, docs_of, libraries):
    extra = [(i % 7, t) for i, t in enumerate(odd_texts())] + [(None, "same text"), (None, "same text"), (5, "▁ no"), (6, "ab" * 9_000)]
    docs = some_docs.union(docs_of(extra).select("doc_id", "text"))
    want = sorted(digests([(r.doc_id, r.text) for r in docs.collect()], libraries), key=str)
    got = token_alignment.digest(docs, *PATHS, characters=20_000, links=5_000)  # many batches and chunks
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert token_alignment.digest(docs.limit(0), *PATHS).collect() == []
    assert sorted(tuple(r) for r in token_alignment.digest(docs_of([(1, None), (2, "")]), *PATHS).collect()) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_gives_tokens_cuts_and_overlaps(docs_of, libraries):
    rows = [(1, "An unbelievable alignment of tokenizers"), (2, ""), (3, " ".join(f"lorem{i}" for i in range(700)))]
    for r in token_alignment.align(docs_of(rows), *PATHS).collect():
        groups = groups_of(rows[r.doc_id - 1][1], libraries)
        assert r.a_ids == [x for a, _ in groups for x in a] and r.b_ids == [x for _, b in groups for x in b]
        assert r.cuts_a == list(itertools.accumulate(len(a) for a, _ in groups)) and r.cuts_b == list(itertools.accumulate(len(b) for _, b in groups))
        enc = token_alignment.tokenizers(*PATHS)
        spans = [[(e - of[i].__len__(), e) for i, e in zip(ids, itertools.accumulate(len(of[i]) for i in ids))]
                 for of, ids in ((enc.bytes_a, r.a_ids), (enc.bytes_b, r.b_ids))]
        overlap = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e] if r.doc_id < 3 else None
        assert overlap is None or list(zip(r.links_a, r.links_b)) == overlap


def test_large_groups_count_ids_before_pairing():
    batch = object.__new__(token_alignment.Batch)
    rng = np.random.default_rng(2)
    batch.a, batch.b = rng.integers(0, 9, 300), rng.integers(0, 9, 250)
    batch.first_a, batch.cuts_a, batch.cuts_b = np.array([0, 280, 300]), np.array([100, 280, 300]), np.array([90, 220, 250])
    batch.group_a, batch.group_b, batch.first_group = np.diff(batch.cuts_a, prepend=0), np.diff(batch.cuts_b, prepend=0), np.array([0, 2, 3])
    want = Counter()
    for doc, (a, b, c, d) in ((0, (0, 100, 0, 90)), (0, (100, 280, 90, 220)), (1, (280, 300, 220, 250))):
        want.update((doc, int(x), int(y)) for x in batch.a[a:b] for y in batch.b[c:d])
    keys, times = batch.pairs(4)
    assert {(k >> 8, k >> 4 & 15, k & 15): n for k, n in zip(keys.tolist(), times.tolist())} == want


# --- vantage-point search ----------------------------------------------------------------------------

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def brute(rows, k):
    fit = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    out = []
    for at, (i, q) in enumerate(fit):
        if i is None or i % 100:
            continue
        found = sorted((float(vantage_search.distances(x, q)), j is None, j) for n, (j, x) in enumerate(fit) if n != at and len(x) == len(q))
        out += [(i, rank + 1, j, d) for rank, (d, _, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def vectors_with_oddities(n=2_500):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 8))
    rows = [(i, (centres[i % 12] + 0.3 * rng.standard_normal(8)).tolist()) for i in range(n)]
    copy = rows[300][1]
    rows += [(9_000 + i, copy) for i in range(700)] + [(100, rows[100][1]), (100, rows[17][1]), (200, rows[200][1])]  # a hot group, repeated ids and rows
    rows += [(None, rows[400][1]), (None, None), (9_900, None), (9_800, [0.0] * 8), (10_000, [1.0, float("nan")] * 4), (10_100, [None] * 8), (10_200, []),
             (10_300, [float("inf")] * 8), (10_400, [1.0, 2.0]), (10_500, [1.0, 2.5]), (10_600, [3.0]), (10_700, [1e200] * 8), (10_800, [-1e200] * 8)]
    return rows


def test_factor_one_is_exact(spark):
    rows = vectors_with_oddities()
    df = spark.createDataFrame(rows, VECTORS).withColumn("rank", F.lit("x")).withColumn("score", F.lit("x"))
    got = vantage_search.nearest(df, F.col("vec_id") % 100 == 0, factor=1.0, shard_rows=300, sample=200, leaf=8, block=7)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 10)


def test_few_and_no_candidates(spark):
    some = spark.createDataFrame([(100, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [4.0, 6.0])], VECTORS)
    found = vantage_search.nearest(some, F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [tuple(r) for r in found] == [(100, 1, 7, 0.0), (100, 2, 8, 5.0)]
    assert vantage_search.nearest(some.where("vec_id = 7"), F.col("vec_id") % 100 == 0).collect() == []
    assert vantage_search.nearest(some.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_recall_of_the_registered_query(spark):
    folder = "/root/testdata/sf0.1"
    got = defaultdict(list)
    for r in queries.op12_vantage_search(spark, folder).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = defaultdict(list)
    for i, rank, j, d in sorted(brute(rows, 10), key=lambda r: r[:2]):
        want[i].append((rank, j, d))
    assert set(got) == set(want) and all([r for r, _, _ in v] == list(range(1, 11)) for v in got.values())
    hits = sum(len({j for _, j, _ in got[i]} & {j for _, j, _ in want[i]}) for i in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    at = {i: np.array(v, float) for i, v in rows}
    assert all(d == float(vantage_search.distances(at[j], at[i])) for i, v in got.items() for _, j, d in v)


# --- phrase mining -----------------------------------------------------------------------------------

TEXTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())])


def texts_with_phrases():
    rng = random.Random(4)
    words = ["New", "York", "the", "of", "a", "é", "naïve", "x\x1cy", "日本", "b"] + [f"w{i}" for i in range(40)]
    weights = [9, 9, 20, 15, 12, 4, 4, 3, 3, 5] + [1] * 40
    rows = []
    for i in range(250):
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for w in rng.choices(words, weights, k=rng.randrange(0, 60)))
        rows.append((rng.choice(["en", "de", None]), text.replace("New York", "New  York city")))
    rows += [("en", None), ("en", ""), ("fr", " . ,"), ("xx", "a a a a a a a a a a a a a"), ("xx", "go " * 5_000), ("xx", "same old story " * 30)]
    return rows + rows[:20] * 3


def duck_rows(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE docs (lang VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO docs VALUES (?, ?)", rows)
    return sorted(con.sql(phrase_mining_sql("docs")).fetchall())


@pytest.mark.parametrize("parsing", [{}, {"modulus": 2, "max_chunk": 3, "words": 100, "filter_bits": 64}])
def test_phrases_equal_sql(spark, parsing):
    rows = texts_with_phrases()
    df = spark.createDataFrame(rows, TEXTS).withColumns({c: F.lit("x") for c in ("phrase", "n", "a", "score", "chunk", "times")})
    got = phrase_mining.mine(df, **parsing)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(tuple(r) for r in got.collect())
    assert got == duck_rows(rows) and {r[0] for r in got} == {"en", "de", "und", "xx"}


def test_no_phrases(spark):
    empty = spark.createDataFrame([], TEXTS)
    assert phrase_mining.mine(empty).collect() == []
    assert phrase_mining.mine(spark.createDataFrame([("en", None), (None, "")], TEXTS)).collect() == []


def test_scores_beyond_64_bits(spark):
    one = spark.createDataFrame([("en", "left right")], TEXTS)
    counts = phrase_mining.phrase_counts(one, max_words=2, min_count=1)
    assert sorted(tuple(r)[1:] for r in counts[0].collect() if r.phrase) == [("left", 1), ("right", 1)]
    got = spark.sql("SELECT (cast(9000000000000000 as decimal(19,0)) * cast(9000000000000000 as decimal(19,0)) * 1000000bd) div "
                    "(cast(9000000000000001 as decimal(19,0)) * cast(9000000000000003 as decimal(19,0))) AS s").first().s
    assert got == 10**6 * 9000000000000000**2 // (9000000000000001 * 9000000000000003)


def test_words_that_share_a_key_are_counted_anew(spark):
    rows = texts_with_phrases()
    df = spark.createDataFrame(rows, TEXTS)
    assert sorted(tuple(r) for r in phrase_mining.mine(df, key_bits=5).collect()) == duck_rows(rows)


def test_long_phrases_are_counted_by_keys(spark):
    rows = texts_with_phrases()
    df = spark.createDataFrame(rows, TEXTS)
    singles, pairs, triples = phrase_mining.key_counts(df)
    assert [c.columns for c in (singles, pairs, triples)] == [["k1", "lang", "phrase", "f"], ["k1", "k2", "f"], ["k1", "k2", "k3", "f"]]
    assert {t for c in (pairs, triples) for _, t in c.dtypes} == {"bigint"}  # no text is sent
    want, blanks, ends = Counter(), str.maketrans("\t", " "), "".join(map(chr, phrase_mining.ENDS))
    for lang, text in rows:
        lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in lower.translate(str.maketrans(ends, "\n" * len(ends))).split("\n"):
            words = [w for w in piece.translate(blanks).split(" ") if w]
            want.update((lang or "und", " ".join(words[k:k + n])) for n in (1, 2, 3) for k in range(len(words) - n + 1))
    got = [tuple(r) for c in phrase_mining.phrase_counts(df) for r in c.where("phrase is not null").collect()]
    assert sorted(got) == sorted((*key, f) for key, f in want.items() if f >= 10)


def test_hashes_of_words_by_their_bytes():
    rng = random.Random(6)
    words = sorted({bytes(rng.choice(b"ab\x00") for _ in range(n)) for n in [*range(20), 63, 64, 65, 66, 130, 5_000] for _ in range(6)})
    words += [w[:-1] + b"c" for w in words if len(w) > 60] + [w[1:2] + w[:1] + w[2:] for w in words if len(w) > 60 and w[0] != w[1]]
    words = sorted(set(words))
    found = []
    for order in (words, words[::-1]):
        data = np.frombuffer(b"x".join(order), np.uint8)
        ends = np.cumsum([len(w) + 1 for w in order]) - 1
        found += [dict(zip(order, phrase_mining._word_hashes(data, ends - [len(w) for w in order], ends, salt).tolist())) for salt in (0, 1)]
    assert found[0] == found[2] and found[1] == found[3] and all(len(set(f.values())) == len(words) for f in found)
    assert not set(found[0].values()) & set(found[1].values())


def test_parse_covers_each_ngram_once():
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 90))) + rng.choice([".", "", "\n x"]) for _ in range(60)]
    for overlap, modulus, longest in ((1, 2, 4), (2, 3, 5), (3, 4, 1_000), (2, 1, 7)):
        want, got = Counter(), Counter()
        for i, t in enumerate(texts):
            for piece in phrase_mining.ENDS.decode().join([t]).replace(".", "\n").split("\n"):
                words = piece.split()
                want.update((i, n, tuple(words[k:k + n])) for n in range(1, overlap + 2) for k in range(len(words) - n + 1))
        for chunk, i, inner in zip(*phrase_mining.parse(texts, overlap, modulus, longest)):
            words = chunk.decode().split(" ")
            assert len(words) <= longest + overlap
            got.update((i, n, tuple(words[k:k + n])) for n in range(1, overlap + 2) for k in range(len(words) - n + 1)
                       if not inner or k + n > overlap)
        assert got == want
