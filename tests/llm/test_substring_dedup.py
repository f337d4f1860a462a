import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tests.llm.data import no_documents, odd_documents, odd_rows
from threadlens.llm import slices, substring_dedup


def brute(rows, window):
    """Key, words, removed words, spans and kept text of each row, by comparing whole windows."""
    texts = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    first = {}
    for k, ws in texts:
        for i in range(len(ws) - window + 1):
            at = (k is not None, k or 0, i)
            first[tuple(ws[i:i + window])] = min(first.get(tuple(ws[i:i + window]), at), at)
    out = Counter()
    for k, ws in texts:
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < (k is not None, k or 0, i):
                gone[i:i + window] = [True] * window
        spans = tuple((m.start(), m.end()) for m in re.finditer("1+", "".join("01"[g] for g in gone)))
        out[k, len(ws), sum(gone), spans, " ".join(w for w, g in zip(ws, gone) if not g)] += 1
    return out


def found(df):
    return Counter(
        (r["doc_id"], r["n_words"], r["n_removed"], tuple((s["start"], s["end"]) for s in r["spans"]), r["kept"])
        for r in df.collect())


def repeating(seed, n=60):
    """Texts with passages that others share, copies, loops inside a text, and a passage in a third of all texts."""
    rng = random.Random(seed)
    some = lambda k: [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(k)]
    common, passages = some(30), [some(rng.randint(3, 45)) for _ in range(6)]
    rows = []
    for i in range(n):
        words = some(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            words += rng.choice(passages) + some(rng.randint(0, 12))
        if i % 3 == 0:
            words += common
        rows.append((rng.randint(-5, 2 * n), " ".join(words)))
    return rows + [(500, "x y " * 60), (501, "é " * 25), (None, rows[0][1]), (7, rows[1][1]), (7, rows[1][1])] + rows[2:5]


@pytest.mark.parametrize("window", [1, 4, 7, 20])
def test_against_all_windows(spark, window, monkeypatch):
    rows = repeating(window)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(substring_dedup.find_repeats(docs, window=window)) == brute(rows, window)


def test_small_slices_and_buckets(spark, monkeypatch):
    """Many slices and buckets, as in large tables."""
    rows = repeating(3, 90)
    monkeypatch.setattr(slices, "SLICE_BYTES", 200)
    cut = lambda batches, text: slices_of(batches, text, 200)
    slices_of = slices.slices
    monkeypatch.setattr(substring_dedup, "slices", cut)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 100)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(substring_dedup.find_repeats(docs, window=6)) == brute(rows, 6)


def test_odd_documents(spark):
    rows = [(r[0], r[1]) for r in odd_rows()] + [(900, "w " * 50_000), (901, "x" * 300_000)]
    docs = odd_documents(spark).select("doc_id", "text", "body", "key").unionByName(
        spark.createDataFrame(rows[-2:], "doc_id bigint, text string"), allowMissingColumns=True)
    df = substring_dedup.find_repeats(docs)
    assert df.columns == ["doc_id", "n_words", "n_removed", "spans", "kept"]
    assert found(df) == brute(rows, 20)
    assert substring_dedup.find_repeats(no_documents(spark)).collect() == []


def test_words_and_slices():
    texts = pa.array(["", " \n", "a", " b\x0bc\x0cd ", "é\x1cf\x85g", "\x00 h"])
    words, counts = slices.words_of(texts)
    assert words.to_pylist() == ["a", "b", "c", "d", "é\x1cf\x85g", "\x00", "h"]
    assert counts.tolist() == [0, 0, 1, 3, 1, 2]
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", None, "defgh", "", "x", "yz"])], names=["t"])
    assert [t.num_rows for _, t in slices.slices([batch, batch.slice(0, 1)], "t", 4)] == [3, 4]


def test_order_is_checked():
    answers = {0: pa.table({"mark": [5, 5]})}
    assert slices.answers_for(answers, 1, 9) is None
    with pytest.raises(RuntimeError):
        slices.answers_for(answers, 0, 6)
