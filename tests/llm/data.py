"""Small tables with what operators must bear: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

CLASHING = "key string, body string, size string, score string, fingerprint string, n_words string, source_size string, _text string, label string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, {CLASHING}"
WORDS = "the of and thin ther ing ation ered oush ble that anin wher stor lyon dath ere rean tion ess".split()


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "x"]) for _ in range(n))


def odd_rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    texts = [
        None, "", "   \n\t ", "a", "A b\nC  d\r\n", "é ß 中文 Ａ   x y", "<|endoftext|> a<|startoftext|>b", words(rng, 9),
        words(rng, 10), words(rng, 40), words(rng, 40) + " #$%", words(rng, 3000), "zz " * 400, "\x00 \x1c \x85 b", "👍🏽 !!! ...",
    ]
    texts += [words(rng, 30)] * 6 + [words(rng, rng.randint(5, 60)) for _ in range(25)]
    rows = [
        (i, t, ["en", "de", None][i % 3], ["src1", "src0", None, "é", "src10"][i % 5], *["clash"] * 9) for i, t in enumerate(texts)
    ]
    return rows + [rows[9], rows[9], (None, words(rng, 20), None, None, *[None] * 9)]


def odd_documents(spark, parts: int = 4):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(parts)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
