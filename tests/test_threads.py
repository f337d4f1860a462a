import pytest
from pyspark.sql import functions as F

from threadlens.operators import lookup as lo
from threadlens.operators import threads as th
from threadlens.sources import tables as io
from threadlens.sources import tweets as src

BRAND = "HelpDesk"
RAW = [
    ("1", "ann", "True", "Wed Jan 01 10:00:00 +0000 2020", "my phone is dead", "2", None),
    ("2", BRAND, "False", "Wed Jan 01 10:05:00 +0000 2020", 'Hold "power",\nthen wait', "3, 77", "1"),
    ("3", "ann", "1", "Wed Jan 01 10:10:00 +0000 2020", "it works, thanks!", None, "2"),
    ("10", "bob", "true", "Thu Jan 02 09:00:00 +0000 2020", "where is my order", "11", None),
    ("11", BRAND, "False", "Thu Jan 02 09:10:00 +0000 2020", "which number?", "12", "10"),
    ("12", "bob", "True", "someday", "sent it, still nothing", "13", "11"),
    ("13", BRAND, "False", "Thu Jan 02 10:00:00 +0000 2020", "refunded", None, "12"),
    ("20", BRAND, "False", "Fri Jan 03 09:00:00 +0000 2020", "lost parent", None, "999"),
    ("30", BRAND, "False", "Fri Jan 03 09:00:00 +0000 2020", "cross post", "2", "2"),
]
COLUMNS = ", ".join(f"{c} string" for c in src.RAW_COLUMNS)


@pytest.fixture
def tweets(spark):
    return src.typed(spark.createDataFrame(RAW, COLUMNS))


def rows(df):
    return {r["brand_tweet_id"]: r for r in df.collect()}


def test_only_replies_to_customers_make_pairs(tweets):
    assert set(rows(th.build_pairs(tweets, BRAND))) == {"2", "11", "13"}


def test_prior_context_needs_a_customer(tweets):
    assert rows(th.build_pairs(tweets, BRAND))["13"]["prior_context"] is None


def test_prior_context_of_a_second_customer_message(spark):
    again = [*RAW, ("40", "ann", "True", RAW[0][3], "hello again", None, "1"),
             ("41", BRAND, "False", RAW[0][3], "hi", None, "40")]
    pairs = rows(th.build_pairs(src.typed(spark.createDataFrame(again, COLUMNS)), BRAND))
    assert pairs["41"]["prior_context"] == "my phone is dead"


def test_followup_is_the_first_listed_customer_answer(tweets):
    pairs = rows(th.build_pairs(tweets, BRAND))
    assert pairs["2"]["followup_text"] == "it works, thanks!"
    assert pairs["13"]["followup_text"] is None


def test_response_seconds(tweets):
    pairs = rows(th.build_pairs(tweets, BRAND))
    assert pairs["2"]["response_seconds"] == 300.0
    assert pairs["13"]["response_seconds"] is None  # the question's date cannot be read


def test_drop_counts_add_up(tweets):
    counts = th.pair_drop_counts(tweets, BRAND).first().asDict()
    assert counts == {"brand_tweets": 5, "missing_parent": 1, "parent_not_customer": 1, "valid_pairs": 3}


def hot_tweets(spark, replies=300):
    """One customer message with most replies, each answered by one customer; copies included."""
    many = [("q", "c", "True", RAW[0][3], "the hot question", None, "p"),
            ("p", "d", "True", RAW[0][3], "the first message", None, None),
            ("f", "c", "True", RAW[2][3], "the hot answer", None, None),
            ("q", "c", "True", RAW[2][3], "a later copy", None, None)]
    many += [(f"b{i // 2}", BRAND, "False", RAW[1][3], "reply", "f" if i % 3 else None, "q") for i in range(replies)]
    many += [(f"q{i}", "e", "True", RAW[0][3], f"question {i}", None, "p") for i in range(replies)]
    many += [(f"c{i}", BRAND, "False", RAW[1][3], "reply", None, f"q{i}") for i in range(replies)]
    return src.typed(spark.createDataFrame(many, COLUMNS))


def test_split_keys_give_the_same_pairs(spark):
    tweets = hot_tweets(spark)
    plain = th.build_pairs(tweets, BRAND)
    split = th.build_pairs(tweets, BRAND, rows_per_split=7)
    assert plain.count() == 600
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert plain.filter("customer_text = 'the hot question' and prior_context = 'the first message'").count() == 300
    assert plain.filter("followup_text = 'the hot answer'").count() == 200


def test_heavy_keys_are_spread_over_slots(spark):
    left = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("seat"))
    lookup = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    heavy = lo.heavy_buckets(counts, "k", {"x": "n"}, 100)
    assert [r["_splits"] for r in heavy.collect()] == [10]
    joined = lo.salted_lookup(left, lookup, "k", "x", heavy, F.col("seat"), "left")
    assert joined.filter("v = 1").count() == 1000


def test_all_heavy_keys_are_listed(spark):
    counts = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(7).alias("n"), F.lit(5).alias("m"))
    heavy = lo.heavy_buckets(counts, "k", {"x": "n", "y": "m"}, 6)
    buckets = {r["_bucket"] for r in heavy.collect()}
    assert buckets == {r[0] for r in counts.select(lo.bucket_of("x", F.col("k"))).collect()}


def test_pairs_read_their_table_three_times(spark, tweets, tmp_path):
    tweets.write.parquet(str(tmp_path / "t"))
    pairs = th.build_pairs(spark.read.parquet(str(tmp_path / "t")), BRAND)
    assert len(rows(pairs)) == 3
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("FileScan parquet") <= 3 and final.count("ReusedExchange") >= 3, final


def test_duplicate_ids_keep_the_earliest_dated_row(spark):
    twice = [("1", "a", "True", None, "undated", None, None), ("1", "a", "True", RAW[2][3], "late", None, None),
             ("1", "a", "True", RAW[0][3], "early b", None, None), ("1", "a", "True", RAW[0][3], "early a", None, None)]
    tweets = src.typed(spark.createDataFrame(twice, COLUMNS))
    assert [r["text"] for r in th.unique_tweets(tweets, "text", "inbound").collect()] == ["early a"]


def test_csv_round_trip(spark, tmp_path):
    raw = spark.createDataFrame(RAW, COLUMNS)
    raw.write.options(**io.CSV_TEXT).csv(str(tmp_path / "raw"))
    loaded = src.load_tweets(spark, str(tmp_path / "raw"))
    assert sorted(map(str, loaded.collect())) == sorted(map(str, src.typed(raw).collect()))


def test_undated_counts(spark):
    raw = spark.createDataFrame([*RAW, ("50", "x", "yes", None, "t", None, None)], COLUMNS)
    assert src.undated_counts(raw).first().asDict() == {"n_rows": 10, "undated": 2, "unparsed": 1, "missing": 1}


def test_pairs_survive_both_formats(spark, tweets, tmp_path):
    pairs = th.build_pairs(tweets, BRAND)
    io.write_pairs(pairs, str(tmp_path / "p"), str(tmp_path / "c"))
    written = sorted(map(str, pairs.collect()))
    assert sorted(map(str, io.read_parquet(spark, str(tmp_path / "p")).collect())) == written
    assert sorted(map(str, io.read_csv(spark, str(tmp_path / "c"), pairs.schema).collect())) == written


def test_first_of_duplicates_needs_texts_only_for_ties(spark):
    """Dates decide; the text does only where the earliest messages of an id are of both kinds."""
    from threadlens.operators.threads import first_inbound, unique_tweets

    rows = [
        ("1", 5, "b", True), ("1", 3, "z", False), ("2", None, "a", True), ("2", 9, "b", False), ("3", 4, "b", True), ("3", 4, "a", False),
        ("4", 4, "a", True), ("4", 4, "a", False), ("5", None, "b", True), ("5", None, "a", False), ("6", 1, None, True), ("6", 1, "x", False),
    ]
    tweets = spark.createDataFrame(rows, "tweet_id string, s long, text string, inbound boolean").withColumn(
        "created_at", F.timestamp_seconds("s")).drop("s")
    expected = {r["tweet_id"]: r["inbound"] for r in unique_tweets(tweets, "created_at", "text", "inbound").collect()}
    found = {r["tweet_id"]: r["inbound"] for r in first_inbound(tweets).collect()}
    assert found == expected and len(found) == 6
