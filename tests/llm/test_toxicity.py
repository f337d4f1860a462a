import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import SCHEMA, no_documents, odd_documents
from threadlens.llm import toxicity as tx

LABELS = "doc_id bigint, toxic int, score string"


def folder(spark, name, sf="sf0.01"):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")


@pytest.fixture(scope="module")
def model(spark):
    usable = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    return tx.train(folder(spark, "documents"), folder(spark, "labels"), usable)


def test_held_out_accuracy(spark, model):
    scored = tx.score_toxicity(folder(spark, "documents"), model).join(folder(spark, "labels"), "doc_id")
    held = scored.filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 1).toPandas()
    hit = held.score >= 0.7
    assert (hit & (held.toxic == 1)).sum() / (held.toxic == 1).sum() >= 0.7
    assert (hit & (held.toxic == 0)).sum() <= 0.01 * (held.toxic == 0).sum()


@pytest.mark.parametrize("text, meant", [
    ("an 1d10t", "an idiot"), ("s t u p i d", "stupid"), ("m-o-r-o-n", "moron"), ("i.d.i.o.t", "idiot"),
    ("stuuuupid", "stupid"), ("$tupid", "stupid"), ("tr@sh", "trash"), ("cl0wn!!!", "clown"), ("p4th3tic,", "pathetic"),
])
def test_disguised_words(model, text, meant):
    assert tx.restore_text(text, model.value.cost) == meant


def test_disguise_does_not_lower_the_score(model):
    score = tx.scorer(model)()
    plain, hidden, clean = score(["you stupid idiot", "you $tup1d i d i o t", "the of and then"])
    assert plain > 0.7 and hidden > 0.7 and clean < 0.3


def test_character_counts_cover_all_text(spark):
    docs = odd_documents(spark)
    found = {r["cell"]: r["n"] for r in tx.count_characters(docs).collect()}
    expected = np.zeros(tx.SIDE**3, int)
    for (text,) in docs.select("text").collect():
        for word in "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in (text or "").lower()).split(" "):
            codes = [0, 0, *tx.class_of(word), 0] if word else []
            for a, b, c in zip(codes, codes[1:], codes[2:]):
                expected[(a * 64 + b) * 64 + c] += 1
    assert found == {int(i): int(expected[i]) for i in np.flatnonzero(expected)}


def test_odd_rows(spark, model):
    docs = odd_documents(spark)
    scored = tx.score_toxicity(docs, model)
    rows = scored.collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 9}) == 1
    kept = tx.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] < 0.7 for r in rows)


def test_without_rows_or_labels(spark, model):
    assert tx.score_toxicity(no_documents(spark), model).collect() == []
    docs = odd_documents(spark)
    nothing = tx.train(docs, spark.createDataFrame([], LABELS))
    assert {r["score"] for r in tx.score_toxicity(docs, nothing).collect()} == {0.5}
    empty = tx.train(no_documents(spark), spark.createDataFrame([(1, 1, "x"), (None, 1, "x"), (1, None, None)], LABELS))
    assert tx.score_toxicity(docs, empty).count() == docs.count()


def test_label_sample_is_bounded_and_repeatable(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    chosen = tx.training_rows(labels, F.lit(True), 1000, "doc_id", "toxic")
    again = tx.training_rows(labels.repartition(7), F.lit(True), 1000, "doc_id", "toxic")
    assert 850 < chosen.count() < 1150
    assert sorted(chosen.collect()) == sorted(again.collect())


def test_repeated_labels_take_the_larger(spark):
    labels = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], LABELS)
    assert sorted(tuple(r) for r in tx.training_rows(labels, F.lit(True), 10, "doc_id", "toxic").collect()) == [(1, 1), (2, 0)]
