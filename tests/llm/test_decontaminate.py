import hashlib
import re
from collections import Counter

import pytest

from tests.llm.data import no_documents, odd_documents, odd_rows
from threadlens.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string, item string, lang string"


def fold(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def items():
    rows = [r[1] for r in odd_rows()]
    long = " ".join((rows[9] or "").split()[5:25])
    return [
        (10, long), (9, long.upper() + " tail of it"), (10, long), (3, "é, ß!"), (4, None), (5, ""), (6, "  .,"), (None, long),
        (7, " ".join((rows[11] or "").split()[2000:2009])), (8, "not in any document at all I am sure of it now"),
    ]


def brute(rows, given, size):
    windows = {}
    for item, text in given:
        words = fold(text)
        n = min(size, len(words))
        if item is not None and n:
            for i in range(len(words) - n + 1):
                windows.setdefault(tuple(words[i:i + n]), set()).add(str(item))
    out = Counter()
    for r in rows:
        words = fold(r[1])
        hit, found = set(), set()
        for n in range(1, size + 1):
            for i in range(len(words) - n + 1):
                names = windows.get(tuple(words[i:i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[r[0], len(words), len(hit), len(found), sha, bool(hit)] += 1
    return out


@pytest.mark.parametrize("broadcast_words", [10**6, 0])
def test_against_brute_force(spark, broadcast_words):
    bench = spark.createDataFrame([(*i, "x", "y") for i in items()], ITEMS)
    found = dc.find_overlap(odd_documents(spark), bench, size=10, broadcast_words=broadcast_words)
    got = Counter(tuple(r) for r in found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())
    assert got == brute(odd_rows(), items(), 10)
    docs = odd_documents(spark)
    kept = dc.drop_contaminated(docs, bench, size=10, broadcast_words=broadcast_words)
    clean = Counter(k[0] for k, n in brute(odd_rows(), items(), 10).items() if not k[5] for _ in range(n))
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == clean


@pytest.mark.parametrize("broadcast_words", [10**6, 0])
def test_empty_tables(spark, broadcast_words):
    bench = spark.createDataFrame([(*i, "x", "y") for i in items()], ITEMS)
    nothing = spark.createDataFrame([], ITEMS)
    assert dc.find_overlap(no_documents(spark), bench, broadcast_words=broadcast_words).collect() == []
    assert dc.drop_contaminated(odd_documents(spark), nothing).count() == len(odd_rows())
    assert not any(r["contaminated"] for r in dc.find_overlap(odd_documents(spark), nothing).collect())


def test_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, "Alpha beta one two three gamma", "k"), (2, "Clean Text!", "k")], "doc_id bigint, text string, key string")
    bench = spark.createDataFrame([(1, "ONE two, three", "", "")], ITEMS)
    cut = {r["doc_id"]: r["text"] for r in dc.cut_spans(docs, bench, size=3).collect()}
    assert cut == {1: "alpha beta gamma", 2: "Clean Text!"}


def test_equal_hashes_are_compared(monkeypatch):
    monkeypatch.setattr(dc, "_hashes", lambda ids, size: dc.np.zeros(max(len(ids) - size + 1, 0), dc.np.uint64))
    known = dc.WindowSet.build(2, [("a", [b"x", b"y", b"z"])])
    assert [(s, i) for s, _, i in known.occurrences([b"z", b"x", b"y", b"y", b"z"])] == [(1, ["a"]), (3, ["a"])]


@pytest.mark.parametrize("broadcast_words", [10**6, 0])
def test_items_without_an_id_are_hits_without_a_name(spark, broadcast_words):
    docs = spark.createDataFrame([(1, "a one two three b", "k"), (2, "one two three x y z", "k"), (3, "clean", "k")],
                                 "doc_id bigint, text string, key string")
    bench = spark.createDataFrame([(None, "One two, three", "", ""), (None, "q r s", "", ""), (4, "x y z", "", "")], ITEMS)
    found = dc.find_overlap(docs, bench, size=3, broadcast_words=broadcast_words)
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["items"], r["contaminated"]) for r in found.collect()}
    assert got == {1: (3, 0, [], True), 2: (6, 1, ["4"], True), 3: (0, 0, [], False)}
    assert {r["items_sha256"] for r in found.filter("doc_id = 1").collect()} == {hashlib.sha256(b"").hexdigest()}
    kept = dc.drop_contaminated(docs, bench, size=3, broadcast_words=broadcast_words)
    assert [r["doc_id"] for r in kept.collect()] == [3]


@pytest.mark.parametrize("broadcast_words", [10**6, 0])
def test_spans_are_cut_at_any_size_of_benchmark(spark, broadcast_words):
    rows = [(1, "Alpha beta one two three gamma", "k"), (2, "Clean Text!", "k"), (3, None, "k"), (1, "Alpha beta one two three gamma", "m"),
            (4, "one two three", "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    bench = spark.createDataFrame([(1, "ONE two, three", "", "")], ITEMS)
    cut = dc.cut_spans(docs, bench, size=3, broadcast_words=broadcast_words)
    assert cut.columns == docs.columns
    assert Counter(tuple(r) for r in cut.collect()) == Counter([
        (1, "alpha beta gamma", "k"), (1, "alpha beta gamma", "m"), (2, "Clean Text!", "k"), (3, "", "k"), (4, "", "k")])
