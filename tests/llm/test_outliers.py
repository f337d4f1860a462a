import random
import re

import numpy as np
import pytest

from tests.llm.data import SCHEMA, no_documents, odd_documents, odd_rows, words
from threadlens.llm import outliers as ol

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    found = WORD.findall(text)
    spots = {}
    for i in range(len(found) - 4):
        spots.setdefault(tuple(found[i:i + 5]), []).append(i)
    repeated = {j for at in spots.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), again, len(repeated)


CASES = ["a b c d e " * 3, "a b c d e f a b c d e", "x\nx\n\n \n \nx", "a " * 9, "|<>&%$*#", "é\u00a0ß \x85 中", "q w e r t\ny q w e r t"]


@pytest.mark.parametrize("text", CASES + [r[1] for r in odd_rows()])
def test_statistics(text):
    assert ol.statistics_of((text or "").encode()) == plain(text)


def test_chi_square():
    assert ol.chi_square_quantile(0.95, 4) == pytest.approx(9.487729, abs=1e-5)
    assert ol.chi_square_quantile(0.5, 2) == pytest.approx(1.386294, abs=1e-5)


def test_estimates_match_numpy(spark):
    """The same concentration steps, by sorting, with the quantile of the summary's kind."""
    rng = np.random.default_rng(3)
    rows = [(g, *map(float, rng.normal([5, 0.1, 0.1, 0.2], [0.5, 0.3, 0.2, 0.4]))) for g in ("a", "b") for _ in range(200)]
    rows += [("a", 9.0, 5.0, 5.0, 5.0)] * 40
    table = spark.createDataFrame(rows, "g string, x0 double, x1 double, x2 double, x3 double")
    found = {r["g"]: r for r in ol.minimum_covariance(table, ["g"], steps=3, prior=50.0).collect()}
    values = {g: np.array([r[1:] for r in rows if r[0] == g]) for g in ("a", "b")}
    centre = {g: np.sort(v, axis=0)[int(np.ceil(0.5 * len(v))) - 1] for g, v in values.items()}
    inverse = {g: np.diag(1 / np.square(ol.FLOORS)) for g in values}
    for _ in range(3):
        near = {}
        for g, v in values.items():
            d = v - centre[g]
            d2 = np.einsum("ij,jk,ik->i", d, inverse[g], d)
            near[g] = v[d2 <= np.sort(d2)[int(np.ceil(0.75 * len(v))) - 1]]
        scale = ol.consistency(0.75, 4)
        whole = np.vstack(list(near.values()))
        for g, v in near.items():
            own = len(v) / (len(v) + 50)
            centre[g] = own * v.mean(0) + (1 - own) * whole.mean(0)
            inverse[g] = np.linalg.inv(own * np.cov(v.T, bias=True) * scale + (1 - own) * np.cov(whole.T, bias=True) * scale + np.diag(np.square(ol.FLOORS)))
    for g in values:
        assert [found[g][f"m{i}"] for i in range(4)] == pytest.approx(centre[g].tolist(), rel=1e-6)
        assert [found[g][f"w{i}{j}"] for i in range(4) for j in range(i, 4)] == pytest.approx(inverse[g][np.triu_indices(4)].tolist(), rel=1e-5)


def test_planted_outliers_go_and_clean_texts_stay(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randint(12, 400)), "en", f"s{i % 3}", *["c"] * 9) for i in range(300)]
    junk = [
        (1000, " ".join(w + "###" for w in words(rng, 60).split()), "en", "s0", *["c"] * 9),
        (1001, " | ".join(words(rng, 80).split()), "en", "s1", *["c"] * 9),
        (1002, " ".join(w * 5 for w in words(rng, 50).split()), "en", "s2", *["c"] * 9),
    ]
    # an outlying group of its own does not set its own standard
    found = {r["doc_id"]: r["kept"] for r in ol.judge(spark.createDataFrame(rows + junk, SCHEMA)).collect()}
    assert not any(found[i] for i in (1000, 1001, 1002))
    assert sum(not found[i] for i in range(300)) == 0


def test_odd_rows(spark):
    found = ol.judge(odd_documents(spark)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, tuple(r[c] for c in ol.STATISTICS)) for r in found) == sorted(
        (r[0] is None, r[0] or 0, plain(r[1])) for r in odd_rows())
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] is False or not r["base_failed"]


def test_no_documents(spark):
    assert ol.judge(no_documents(spark)).collect() == []
    bad = spark.createDataFrame([(1, "too short", "en", "a", *["c"] * 9)], SCHEMA)
    assert [r["kept"] for r in ol.judge(bad).collect()] == [False]
