import random
import re
from collections import Counter

import pytest

from tests.llm.data import no_documents, odd_documents, odd_rows
from threadlens.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    f = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    f[lang or "und", tuple(ws[i:i + k])] += 1
    return f


def brute(rows, least, top):
    f = counts(rows)
    n = Counter()
    for (lang, g), c in f.items():
        n[lang] += c * (len(g) == 1)
    candidates = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    longer = Counter()
    for (lang, g), c in candidates.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                longer[lang, g[i:i + k]] = max(longer[lang, g[i:i + k]], c)
    out = {}
    for (lang, g), a in candidates.items():
        if 100 * longer[lang, g] >= 80 * a and longer[lang, g]:
            continue
        cuts = [(2000000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), left, right))
    return Counter((lang, at, p.decode(), -a, left, right, n[lang], -s)
                   for lang, found in out.items() for at, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def texts(seed, n=120):
    """Texts over few words with fixed phrases, one of them in a third of all texts."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "A", "cat", "Dog", "é", "b\x01", "b", "x#", "runs", "home", "中"]
    weights = [12, 8, 4, 3, 3, 2, 2, 2, 2, 1, 1, 1]
    rows = []
    for i in range(n):
        parts = rng.choices(vocabulary, weights, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(["New York City hall", "red\thot", "of the", "a  b\x01 c", "end. of", "x, y", "l\nm"]))
        if i % 3 == 0:
            parts += ["all rights reserved here"] * 2
        rows.append((rng.choice(["en", "en", "de", None, "und"]), " ".join(parts)))
    return rows


@pytest.mark.parametrize("budget,least", [(1_000_000, 5), (60, 5), (8, 3), (1, 2)])
def test_against_all_phrases(spark, budget, least):
    """Small budgets extend prefixes to two, three and four words."""
    rows = texts(budget)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    found = phrases.collocations(docs, least=least, top=50, budget=budget)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(tuple(r) for r in found.collect()) == brute(rows, least, 50)


def test_all_counts(spark):
    rows = texts(9)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    words, found, _ = phrases.frequent_phrases(docs, least=3, budget=10)
    name = {r["id"]: (r["lang"], r["word"]) for r in words.collect()}
    assert len(name) == words.count()
    got = Counter()
    for r in found.collect():
        ids = [r[w] for w in phrases.WORDS if r[w]]
        assert len({name[i][0] for i in ids}) == 1
        got[name[ids[0]][0], tuple(name[i][1] for i in ids)] += r["a"]
    assert got == Counter({k: c for k, c in counts(rows).items() if len(k[1]) > 1 and c >= 3})


def test_odd_documents(spark):
    rows = [(r[2], r[1]) for r in odd_rows()] + [("en", "w v " * 30_000), ("en", "x" * 300_000)]
    docs = odd_documents(spark).select("lang", "text", "key", "body").unionByName(
        spark.createDataFrame(rows[-2:], "lang string, text string"), allowMissingColumns=True)
    assert Counter(tuple(r) for r in phrases.collocations(docs, least=5, top=2000).collect()) == brute(rows, 5, 2000)
    assert phrases.collocations(no_documents(spark)).collect() == []
