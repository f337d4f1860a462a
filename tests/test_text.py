import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from threadlens.functions import text as tx
from threadlens.functions.words import DOMAIN_STOP_WORDS, LATIN_WORD, WORD, stop_words
from threadlens.operators import classify as cl
from threadlens.operators import cluster as cu
from threadlens.operators import features as fe
from threadlens.operators import retrieve as rt
from threadlens.operators import term_counts as tc

TEXTS = [
    (1, "battery battery drains fast"), (2, "Battery drains"), (3, "screen is black, battery fine"), (4, ""), (5, None),
]


def test_topic_words_start_with_a_letter(spark):
    df = spark.createDataFrame([("it's 115858 a1b wi-fi x don't 4get",)], "t string")
    assert df.select(tx.tokens(F.col("t"), LATIN_WORD)).first()[0] == ["it's", "wi", "fi", "don't"]


def test_stop_words_leave_before_pairs_are_made(spark):
    df = spark.createDataFrame([("the red of car",), ("red",), ("",), (None,)], "t string")
    grams = [r["g"] for r in tx.with_grams(df, "t", "g", WORD, ["the", "of"]).collect()]
    assert grams == [["red", "car", "red car"], ["red"], [], []]


def test_default_stop_words_include_the_domain(spark):
    assert {"the", "iphone"} <= set(stop_words(DOMAIN_STOP_WORDS))


def test_vocabulary_counts_documents_and_occurrences(spark):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    found = fe.vocabulary(df, "t", fe.TextOptions(min_df=2, pairs=False))
    assert [tuple(r) for r in found.collect()] == [("battery", 3, 4), ("drains", 2, 2)]


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    model = fe.fit_text_model(df, "t", fe.TextOptions(min_df=2, pairs=False))
    battery, drains = math.log(6 / 4) + 1, math.log(6 / 3) + 1
    norm = math.hypot(2 * battery, drains)
    weights = {(r["id"], r["term"]): r["weight"] for r in model.weights(df, "t", "id").collect()}
    assert weights[(1, "battery")] == pytest.approx(2 * battery / norm)
    assert weights[(1, "drains")] == pytest.approx(drains / norm)
    assert weights[(3, "battery")] == pytest.approx(1.0)
    empty = {r["id"]: r["features"].numNonzeros() for r in model.vectors(df, "t").collect()}
    assert len(empty) == 5 and empty[4] == empty[5] == 0


def zipf_texts(rows=400, words=300):
    rng = np.random.default_rng(3)
    pick = lambda: " ".join(f"w{int(i) % words}" for i in rng.zipf(1.3, size=rng.integers(0, 40)))
    return [(i, pick()) for i in range(rows)] + [(rows, None), (rows, ""), (None, "w1 w1 w1 w2"), (3, "ÄÖ äö 𠀀𠀁 w1")]


@pytest.mark.parametrize("most, min_df, pairs, pattern", [
    (20, 2, True, WORD), (20, 2, False, WORD), (5000, 1, True, WORD), (40, 30, True, WORD), (25, 2, True, "w[0-9]+( w1)?"),
])
def test_vocabulary_and_weights_match_all_terms(spark, most, min_df, pairs, pattern):
    df = spark.createDataFrame(zipf_texts(), "id int, t string")
    options = fe.TextOptions(most, min_df, pattern, ("w5",), pairs)
    grams = [r["g"] for r in options.grams(df, "t", "g").collect()]
    total, documents = Counter(g for row in grams for g in row), Counter(g for row in grams for g in set(row))
    wanted = sorted((-n, t, documents[t]) for t, n in total.items() if documents[t] >= min_df)[:most]
    assert [tuple(r) for r in fe.vocabulary(df, "t", options).collect()] == [(t, d, -n) for n, t, d in wanted]
    model = fe.fit_text_model(df, "t", options)
    by_vector = Counter(
        (r["id"], model.terms[i], round(float(v), 9)) for r in model.vectors(df, "t").collect()
        for i, v in zip(r["features"].indices, r["features"].values))
    assert Counter((r["id"], r["term"], round(r["weight"], 9)) for r in model.weights(df, "t", "id").collect()) == by_vector


def test_rare_pairs_are_not_counted_one_by_one(spark, monkeypatch):
    """Ten words in 200 texts are the vocabulary's size; of 2,000 pairs only the frequent one can be among the terms."""
    texts = [(" ".join([f"a{j}" for j in range(10)] + [f"x{i}y{j}" for j in range(9)] + ["a0 a1"]),) for i in range(200)]
    asked, count_pairs = [], fe.count_pairs
    monkeypatch.setattr(fe, "count_pairs", lambda buckets: asked.append(len(buckets)) or count_pairs(buckets))
    found = fe.vocabulary(spark.createDataFrame(texts, "t string"), "t", fe.TextOptions(10, 1, stop=())).collect()
    assert [tuple(r) for r in found[:4]] == [("a0", 200, 400), ("a0 a1", 200, 400), ("a1", 200, 400), ("a1 a2", 200, 200)]
    assert len(asked) == 1 and 0 < asked[0] < 30


def test_counts_do_not_depend_on_how_rows_are_cut(monkeypatch):
    rows = [["a", "b", "a", "b"], [], ["b"], ["c", "a", "b"] * 5, ["a"]]
    batch = pa.RecordBatch.from_arrays([pa.array([["z", "z"], *rows])], names=["w"]).slice(1)
    every = np.arange(tc.BUCKETS)

    def added():
        total = Counter()
        for part in (*tc.tally(True)([batch]), *tc.count_pairs(every)([batch])):
            for r in part.to_pylist():
                total[r["term"], r["bucket"]] += 1000 * r["df"] + r["total"]
        return total

    whole = added()
    assert whole["a", None] == 3008 and whole["a b", None] == 2007 and whole["b a", None] == 1001
    assert sum(n for (term, _), n in whole.items() if term is None) == 3 + 14
    monkeypatch.setattr(tc, "PIECE_WORDS", 3)
    assert added() == whole


def test_silhouette_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4)) + np.repeat([[0.0], [1.5], [3.0]], 20, axis=0)
    c = [*np.repeat([0, 1, 2], 20)[:-1], 7]  # the last one is alone in its cluster
    gaps = np.linalg.norm(x[:, None] - x[None], axis=2)
    scores = []
    for i in range(60):
        same = [j for j in range(60) if c[j] == c[i] and j != i]
        if not same:
            scores.append(0.0)
            continue
        a = gaps[i, same].mean()
        b = min(gaps[i, [j for j in range(60) if c[j] == o]].mean() for o in set(c) - {c[i]})
        scores.append((b - a) / max(a, b))
    df = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, c)], "v array<double>, c int")
    assert cu.silhouette(df, "v", "c").first()[0] == pytest.approx(np.mean(scores))


def test_sweep_keeps_the_best_k(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(20, 2)) * 0.1 + center for center in ([0, 0], [5, 5], [0, 9])])
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x.tolist())], ["id", "features"])
    found = cu.sweep_kmeans(df, "features", "id", (2, 3, 5, 60), 42, starts=2)
    assert found.k == 3 and [k for k, _, _ in found.scores] == [2, 3, 5]  # 60 is not below the number of rows
    with pytest.raises(ValueError):
        cu.sweep_kmeans(df, "features", "id", (60,), 42)


def brute_force(pool, queries, k):
    """Cosine of hand-made TF-IDF vectors, one idf per intent."""
    best = {}
    for query, text, intent in queries:
        docs = [(i, t.split()) for i, t, n, reply in pool if n == intent and reply]
        df = {w: sum(w in d for _, d in docs) for w in {w for _, d in docs for w in d}}

        def vector(words):
            v = {w: words.count(w) * (math.log((1 + len(docs)) / (1 + df[w])) + 1) for w in set(words) if w in df}
            norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
            return {w: x / norm for w, x in v.items()}

        q = vector(text.split())
        scored = [(-round(sum(x * vector(d).get(w, 0.0) for w, x in q.items()), 6), i) for i, d in docs]
        best[query] = [(i, -s) for s, i in sorted(scored) if s < 0][:k]
    return best


@pytest.mark.parametrize("queries_in_block, characters_in_block, words_broadcast", [(2_000, 4_000_000, 1000), (7, 60, 1000), (7, 60, 3)])
def test_retrieval_matches_brute_force(spark, monkeypatch, queries_in_block, characters_in_block, words_broadcast):
    monkeypatch.setattr(rt, "VOCABULARY_ROWS", words_broadcast)
    monkeypatch.setattr(rt, "QUERY_BLOCK", queries_in_block)
    monkeypatch.setattr(rt, "POOL_BLOCK", characters_in_block)
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(12)]
    text = lambda: " ".join(rng.choice(words, size=rng.integers(1, 7)))
    pool = [(f"p{i:03d}", text(), ["a", "a", "b"][i % 3], "reply" if i % 7 else "") for i in range(90)]
    pool += [(f"x{i}", pool[0][1], "a", "reply") for i in range(10)]  # equal texts tie
    queries = [(f"q{i}", text(), ["a", "b", "c"][i % 3]) for i in range(30)] + [("q_none", "zzz", "a")]
    df = spark.createDataFrame(pool, "brand_tweet_id string, customer_text string, intent string, brand_text string")
    df = df.withColumn("customer_tweet_id", F.col("brand_tweet_id")).repartition(5)
    asked = spark.createDataFrame(queries, "query_id string, question string, asked string")
    retriever = rt.Retriever(df, fe.TextOptions(max_features=5_000, min_df=1, pairs=False), exclude=None)
    found = {}
    for r in retriever.matches(asked, "query_id", "question", "asked").orderBy("rank").collect():
        found.setdefault(r["query_id"], []).append((r["brand_tweet_id"], r["similarity"]))
    expected = brute_force(pool, queries, 3)
    for query, matches in expected.items():
        assert [i for i, _ in found.get(query, [])] == [i for i, _ in matches]
        assert [s for _, s in found.get(query, [])] == pytest.approx([s for _, s in matches])
    lists = {r["query_id"]: r["exemplars"] for r in retriever.retrieve(asked, "query_id", "question", "asked").collect()}
    assert len(lists) == 31 and lists["q_none"] == [] and lists["q2"] == []
    assert {q: len(e) for q, e in lists.items()} == {q: len(m) for q, m in expected.items()}


def test_excluded_ids_are_not_retrieved(spark):
    pool = spark.createDataFrame(
        [("1", "red car", "a", "r", "b1"), ("2", "red bus", "a", "r", "b2")],
        "customer_tweet_id string, customer_text string, intent string, brand_text string, brand_tweet_id string")
    golden = spark.createDataFrame([("1.0",)], "customer_tweet_id string")
    retriever = rt.Retriever(pool, fe.TextOptions(min_df=1), exclude=golden)
    asked = spark.createDataFrame([("q", "red car", "a")], "q string, t string, i string")
    assert [r["brand_tweet_id"] for r in retriever.matches(asked, "q", "t", "i").collect()] == ["b2"]


def vectors(rng, n, terms, most):
    """Unit vectors over integer terms as lists."""
    ids = [np.sort(rng.choice(terms, size=rng.integers(1, most), replace=False)) for _ in range(n)]
    weights = [rng.random(len(i)) + 0.01 for i in ids]
    return [i.tolist() for i in ids], [(w / np.linalg.norm(w)).tolist() for w in weights]


@pytest.mark.parametrize("terms, most", [(9, 6), (400, 8)])
def test_postings_and_matrices_keep_the_best(monkeypatch, terms, most):
    """Any floor below the k-th best and any way of comparing give the same as all similarities."""
    rng = np.random.default_rng(4)
    (pool_ids, pool_w), (ids, w) = vectors(rng, 80, terms, most), vectors(rng, 30, terms, most)
    messages = pa.table({"_pool": [f"p{i:02d}" for i in rng.permutation(80)], "_ids": pool_ids, "_weights": pool_w})
    dense = lambda i, v: np.bincount(i, v, minlength=terms)
    expected, kth = [], []
    for q in range(30):
        every = sorted((-round(float(dense(ids[q], w[q]) @ dense(i, v)), 6), p) for p, i, v in zip(messages["_pool"].to_pylist(), pool_ids, pool_w))
        top = [(f"m{q}", p, -s) for s, p in every if s < 0][:3]
        expected += top
        kth.append(top[2][2] if len(top) == 3 else 0.0)
    for share, cells in ((0.0, 27), (0.5, 8_000_000), (100.0, 8_000_000)):
        monkeypatch.setattr(rt, "DENSE_SHARE", share)
        monkeypatch.setattr(rt, "MATRIX_CELLS", cells)
        monkeypatch.setattr(rt, "CHUNK_ROWS", 7)
        for part in (0.0, 0.5, 1.0):
            visits = pa.table({"_mark": [f"m{q}" for q in range(30)], "_query": ["q"] * 30, "_ids": ids, "_weights": w,
                               "_floor": [max(0.0, part * x - rt.MARGIN) for x in kth]})
            found = rt._scorer(3)(messages, visits).to_pylist()
            got = sorted((r["_mark"], r["_pool"], round(r["similarity"], 6)) for r in found)
            assert got == sorted((m, p, round(s, 6)) for m, p, s in expected)


def large_pool(spark, n, hot=0.0):
    """Messages with a common word and two rare ones, each shared by four; a part of them in one intent and on one topic."""
    mine = F.col("id") % 100 < 100 * hot
    rows = spark.range(n).select(
        F.format_string("p%07d", "id").alias("brand_tweet_id"),
        F.when(mine, "hot").otherwise(F.concat(F.lit("i"), (F.floor(F.col("id") / 12) % 3).cast("string"))).alias("intent"),
        F.concat_ws(" ", F.lit("common"), F.when(mine, "topic"), F.concat(F.lit("a"), F.floor(F.col("id") / 4)),
                    F.concat(F.lit("b"), F.col("id") * 13 % (n // 4))).alias("customer_text"),
        F.lit("reply").alias("brand_text"))
    return rows.withColumn("customer_tweet_id", F.col("brand_tweet_id"))


def test_a_skewed_intent_and_a_skewed_topic(spark, monkeypatch):
    """A third of the pool has one intent and one word in common; the shards stay small and the rows right."""
    monkeypatch.setattr(rt, "POOL_BLOCK", 2_000)
    monkeypatch.setattr(rt, "QUERY_BLOCK", 20)
    pool = large_pool(spark, 1_500, hot=0.34)
    retriever = rt.Retriever(pool, fe.TextOptions(min_df=1, pairs=False), exclude=None)
    queries = pool.filter(F.col("brand_tweet_id").endswith("7")).select(
        F.col("brand_tweet_id").alias("q"), F.col("customer_text").alias("t"), F.col("intent").alias("i"))
    rows = [tuple(r) for r in pool.select("brand_tweet_id", "customer_text", "intent", "brand_text").collect()]
    asked = [tuple(r) for r in queries.collect()]
    found = {}
    for r in retriever.matches(queries, "q", "t", "i").orderBy("rank").collect():
        found.setdefault(r["q"], []).append((r["brand_tweet_id"], round(r["similarity"], 6)))
    assert found == {q: [(i, round(s, 6)) for i, s in m] for q, m in brute_force(rows, asked, 3).items()}
    sizes = [r["count"] for r in retriever.shards.groupBy("_intent", "_shard").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 1_500 / 6


def test_visits_grow_with_pool_and_queries(spark, monkeypatch):
    """At the same selectivity, twice the messages and queries make about twice the visits, not four times."""
    monkeypatch.setattr(rt, "POOL_BLOCK", 4_000)
    counts = []
    for n in (3_000, 6_000):
        pool = large_pool(spark, n)
        retriever = rt.Retriever(pool, fe.TextOptions(min_df=1, pairs=False), exclude=None)
        queries = pool.filter(F.col("brand_tweet_id").endswith("3")).select(
            F.col("brand_tweet_id").alias("q"), F.col("customer_text").alias("t"), F.col("intent").alias("i"))
        seen = []
        whole = rt.Retriever.visits
        monkeypatch.setattr(rt.Retriever, "visits", lambda *a: seen.append(whole(*a)) or seen[-1])
        assert retriever.matches(queries, "q", "t", "i").count() == 3 * queries.count()
        monkeypatch.setattr(rt.Retriever, "visits", whole)
        shards = retriever.shards.select("_intent", "_shard").distinct().count()
        counts.append((queries.count(), shards, seen[0].count()))
    (few, _, visits), (many, shards, more) = counts
    assert many == 2 * few and rt.HOMES * many + more < 2.3 * (rt.HOMES * few + visits)
    assert 0 < more < 0.1 * many * shards / 3


def test_queries_and_messages_are_not_repeated_in_shuffles(spark, monkeypatch):
    """Many blocks of queries and many shards: pairs of them are made where they are compared."""
    monkeypatch.setattr(rt, "POOL_BLOCK", 4_000)
    monkeypatch.setattr(rt, "QUERY_BLOCK", 20)
    pool = large_pool(spark, 1_200)
    queries = pool.filter(F.col("brand_tweet_id").endswith("3")).select(
        F.col("brand_tweet_id").alias("q"), F.col("customer_text").alias("t"), F.col("intent").alias("i"))
    found = rt.Retriever(pool, fe.TextOptions(min_df=1, pairs=False), exclude=None).matches(queries, "q", "t", "i")
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "explode(sequence" not in plan
    assert found.count() == 3 * 120


def test_screened_products_are_exact(monkeypatch):
    """Candidates by 32-bit products, computed with 64 bits, give what the whole matrix gives."""
    rng = np.random.default_rng(6)
    (pool_ids, pool_w), (ids, w) = vectors(rng, 300, 50, 20), vectors(rng, 40, 50, 20)
    pool_ids, pool_w = pool_ids + pool_ids[:50], pool_w + pool_w[:50]  # equal texts tie
    messages = pa.table({"_pool": [f"p{i:03d}" for i in rng.permutation(350)], "_ids": pool_ids, "_weights": pool_w})
    visits = pa.table({"_mark": [f"m{q}" for q in range(40)], "_ids": ids, "_weights": w, "_floor": [0.1] * 40})
    monkeypatch.setattr(rt, "DENSE_SHARE", 0.0)
    monkeypatch.setattr(rt, "CHUNK_ROWS", 16)
    found, taken, take = [], [], rt._Best._take
    monkeypatch.setattr(rt._Best, "_take", lambda *a: taken.append(1) or take(*a))
    for share in (-1.0, 1.0):
        monkeypatch.setattr(rt, "EXACT_SHARE", share)
        found.append(sorted((r["_mark"], r["_pool"], r["similarity"]) for r in rt._scorer(3)(messages, visits).to_pylist()))
        assert bool(taken) == (share > 0)
    assert found[0] == found[1] and len(found[0]) > 100


def test_rare_terms_are_no_columns_of_a_matrix(monkeypatch):
    """Of 2,000 terms, 20 are frequent; the others are added pair by pair, with the same similarities."""
    rng = np.random.default_rng(9)

    def table(mark, n):
        ids = [np.unique([*rng.choice(20, 8, False), *rng.integers(20, 2000, 5)]) for _ in range(n)]
        weights = [rng.random(len(i)) for i in ids]
        weights = [w / np.linalg.norm(w) for w in weights]
        return pa.table({mark: [f"{i:04d}" for i in range(n)], "_ids": pa.array([i.tolist() for i in ids], pa.list_(pa.int32())),
                         "_weights": [w.tolist() for w in weights]}), ids, weights

    messages, ids, weights = table("_pool", 1500)
    asked, asked_ids, asked_weights = table("_mark", 40)
    visits = asked.append_column("_floor", pa.array(np.zeros(40)))
    pool, queries = np.zeros((1500, 2000)), np.zeros((40, 2000))
    for matrix, i, w in ((pool, ids, weights), (queries, asked_ids, asked_weights)):
        for row, (at, value) in enumerate(zip(i, w)):
            matrix[row, at] = value
    product = np.round(queries @ pool.T, rt.DIGITS)
    wanted = [(f"{q:04d}", f"{m:04d}", product[q, m]) for q in range(40) for m in np.lexsort((np.arange(1500), -product[q]))[:3]]
    columns, products = [], rt._Products
    monkeypatch.setattr(rt, "_Products", lambda *a: columns.append(products(*a)) or columns[-1])
    found = rt._scorer(3)(messages, visits).to_pylist()
    assert sorted((r["_mark"], r["_pool"], r["similarity"]) for r in found) == sorted(wanted)
    assert [len(c.matrix) for c in columns] == [20]


@pytest.mark.parametrize("most, min_df, pairs, groups", [(20, 2, True, 10_000), (20, 2, True, 1), (5000, 1, True, 10_000), (15, 1, False, 10_000)])
def test_grouped_vocabulary_matches_all_terms(spark, monkeypatch, most, min_df, pairs, groups):
    monkeypatch.setattr(fe, "MOST_GROUPS", groups)
    rows = [(g, t) for i, (_, t) in enumerate(zipf_texts()) for g in [("a", "b", "c", None)[min(i % 7, 3)]]]
    df, options = spark.createDataFrame(rows, "g string, t string"), fe.TextOptions(most, min_df, WORD, ("w5",), pairs)
    grams = [(r["g"], r["w"]) for r in options.grams(df, "t", "w").collect()]
    wanted = []
    for name in {g for g, _ in grams}:
        total, documents = Counter(), Counter()
        for _, row in (x for x in grams if x[0] == name):
            total.update(row)
            documents.update(set(row))
        kept = sorted((-n, t) for t, n in total.items() if documents[t] >= min_df)[:most]
        wanted += [(name, t, documents[t], -n) for n, t in kept]
    found = fe.grouped_vocabulary(df, "t", "g", options).select("g", "term", "df", "total").collect()
    assert Counter(map(tuple, found)) == Counter(wanted)


def test_rare_pairs_of_groups_are_not_counted_one_by_one(spark, monkeypatch):
    """Each group's ten words are its vocabulary's size; of 2,000 pairs only the frequent ones leave the tasks."""
    texts = [(g, " ".join([f"{g}{j}" for j in range(10)] + [f"x{i}y{j}" for j in range(9)] + [f"{g}0 {g}1"])) for i in range(200) for g in "ab"]
    seen, count = [], fe.count_group_pairs

    def spied(loads, least):
        seen.append((sum(int((loads >= bar).sum()) for bar in least.values()), least))
        return count(loads, least)

    monkeypatch.setattr(fe, "count_group_pairs", spied)
    found = fe.grouped_vocabulary(spark.createDataFrame(texts, "g string, t string"), "t", "g", fe.TextOptions(10, 1, stop=())).collect()
    assert {("a", "a0 a1", 200, 400), ("b", "b0 b1", 200, 400)} <= {(r.g, r.term, r.df, r.total) for r in found}
    assert len(seen) == 1 and seen[0][0] < 100 and seen[0][1] == {"a": 200, "b": 200}


def test_weights_of_a_group_use_its_own_terms():
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3, 4]), pa.array(["x", "y", "z", None]), pa.array([["p", "q", "r"]] * 4)], names=["id", "g", "w"])
    run = tc.weigh(["p", "p q", "p", "q r"], [3.0, 4.0, 1.0, 1.0], True, ["x", "x", "y", "y"])
    found = pa.Table.from_batches(list(run([batch]))).to_pydict()
    assert found["id"] == [1, 2, 3, 4] and found["_positions"] == [[0, 1], [2, 3], [], []]
    assert np.allclose(found["_weights"][0], [0.6, 0.8]) and np.allclose(found["_weights"][1], [0.5**0.5] * 2)


def test_repeated_query_ids_and_many_intents(spark):
    intents = [f"i{n}" for n in range(450)]
    pool = spark.createDataFrame(
        [(f"b{j}-{n}", f"red {w}", n, "reply") for n in intents for j, w in enumerate(("car", "bus", "van", "tram"))],
        "brand_tweet_id string, customer_text string, intent string, brand_text string",
    ).withColumn("customer_tweet_id", F.col("brand_tweet_id"))
    retriever = rt.Retriever(pool, fe.TextOptions(min_df=1), exclude=None)
    rows = [("same", "red bus", "i7")] * 3 + [("same", "red van", "i7")] + [(n, "red car", n) for n in intents]
    asked = spark.createDataFrame([*rows, ("none", None, None), (None, "red car", "i8")], "q string, t string, i string")
    found = retriever.matches(asked, "q", "t", "i").collect()
    assert len(found) == 3 * (2 + 450 + 1)
    mine = sorted((r["rank"], r["brand_tweet_id"]) for r in found if r["q"] == "same")
    assert mine[:2] == [(1, "b1-i7"), (1, "b2-i7")] and [r for r, _ in mine] == [1, 1, 2, 2, 3, 3]
    lists = retriever.retrieve(asked, "q", "t", "i").collect()
    assert len(lists) == 456
    tops = {(r["q"], r["t"]): r["exemplars"][0]["customer_text"] for r in lists if r["exemplars"]}
    assert tops["same", "red bus"] == "red bus" and tops["same", "red van"] == "red van" and tops[None, "red car"] == "red car"
    many = retriever.matches(asked, "q", "t", "i")._jdf.queryExecution().analyzed().toString()
    assert many.count("FlatMapCoGroupsInArrow") == 1  # whatever the number of queries


def test_retrieval_of_empty_tables(spark):
    pool = spark.createDataFrame([("1", "red car", "a", "r", "b1"), ("2", None, "a", "r", None)],
        "customer_tweet_id string, customer_text string, intent string, brand_text string, brand_tweet_id string")
    asked = spark.createDataFrame([("q", "red car", "a")], "q string, t string, i string")
    options = fe.TextOptions(min_df=1)
    assert rt.Retriever(pool.limit(0), options, exclude=None).matches(asked, "q", "t", "i").count() == 0
    assert rt.Retriever(pool, options, exclude=None).matches(asked.limit(0), "q", "t", "i").count() == 0
    assert rt.Retriever(pool, options, exclude=None).matches(asked, "q", "t", "i").count() == 1


def test_classifier_learns_saves_and_loads(spark, tmp_path):
    rows = [(f"battery drains {i % 3}x", "power") for i in range(40)] + [(f"screen is black {i}x", "display") for i in range(8)]
    train = spark.createDataFrame([*rows, ("no label", None)], "t string, intent string")
    model = cl.fit_classifier(train, "t", fe.TextOptions(min_df=2))
    model.save(spark, str(tmp_path / "m"))
    loaded = cl.IntentClassifier.load(spark, str(tmp_path / "m"))
    fresh = spark.createDataFrame([("my battery drains",), ("black screen",), (None,)], "t string")
    first = [r["pred"] for r in model.predict(fresh, "t").collect()]
    assert first[:2] == ["power", "display"] and first[2] in ("power", "display")
    assert [r["pred"] for r in loaded.predict(fresh, "t").collect()] == first


def test_slopes_by_hand(spark):
    """The derivatives of the penalised loss, against dense matrices; no row carries all weights."""
    rows = [(f"battery drains w{i % 5}", "power") for i in range(30)] + [(f"screen w{i % 5} battery", "display") for i in range(9)]
    rows += [("w1 w2 hello", "other"), (None, "other"), ("no label", None)]
    train = spark.createDataFrame(rows, "t string, intent string")
    model = cl.fit_classifier(train, "t", fe.TextOptions(min_df=1), max_iter=2)
    known = model.text_model.vectors(train.filter("intent IS NOT NULL"), "t", "v").select("v", "intent").collect()
    x, w = np.array([r["v"].toArray() for r in known]), model.regression.coefficientMatrix.toArray()
    y = np.array([[r["intent"] == name for name in model.labels] for r in known], float)
    weight = (len(y) / (3 * y.sum(axis=0)))[y.argmax(axis=1)]
    m = x @ w.T + model.regression.interceptVector.toArray()
    p = np.exp(m) / np.exp(m).sum(axis=1, keepdims=True)
    miss = (p - y) * weight[:, None]
    slopes = np.hstack([miss.T @ x / weight.sum() + w / len(y), miss.sum(axis=0)[:, None] / weight.sum()])
    found = {r["intent"]: (r["n"], r["steepest"]) for r in cl.gradient(model, train, "t").collect()}
    assert {c: n for c, (n, _) in found.items()} == {"power": 30, "display": 9, "other": 2}
    assert [found[c][1] for c in model.labels] == pytest.approx(np.abs(slopes).max(axis=1).tolist())
    margins = model.margins(train, "t", "m")
    assert "scalar-subquery" not in margins._jdf.queryExecution().analyzed().toString()
    got = [r["m"] for r in margins.filter("intent IS NOT NULL").collect()]
    assert np.array(got) == pytest.approx(m)
