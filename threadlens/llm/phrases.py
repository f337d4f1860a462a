"""Phrases of two to four words that occur together more than their parts suggest, by vertical partitioning.

A phrase is a run of consecutive words of one piece; texts are folded and cut into pieces at marks and line ends. All counts
are per language. The counts of all phrases come from subtrees of the suffix tree, cut off at ``longest`` words:

1. Words are counted. Only words with at least ``least`` occurrences can be in a phrase with as many, so suffixes end
   before rarer words as they do at the end of a piece.
2. Vertical partitioning: the suffixes that begin with a prefix form a subtree of their own. Prefixes are single words, grouped
   until their counts fill the budget of a task. A word with more occurrences than the budget is extended: its two-word prefixes
   are counted and grouped for themselves, those beyond the budget again are extended to three words, and so on.
   There are at most (words / budget) such prefixes of each length, and the budget grows so that they stay below a million:
   they are the only table that every task gets.
3. A task gets all suffixes of a group, sorts them, and reads the count of each node of depth two and more as the total of its leaves.
   Groups are independent of each other. The nodes of extended prefixes were counted in step 2.

Words and suffixes travel packed, one row per slice of the texts and bucket or group (``slices.py``); equal suffixes of a slice are
one entry with a count, so a phrase that fills a third of all texts is one entry per slice. A word's number is given out by the
bucket that counted it, and each slice is told the numbers of its own words; no vocabulary is broadcast.

Scores: each way of cutting a phrase in two joins it with its parts' counts; all arithmetic is in integers of up to 38
digits.

Null and empty texts have no words, null languages count as ``und``, repeated rows as often as they come; ties are
ordered as stated. An empty table gives no rows. Other columns are ignored. A document is handled as a whole: memory follows the
longest one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threadlens.llm.common import release, stored
from threadlens.llm.slices import (
    answers_for, checksum, mixed, packed, partition, read_answers, slices, store_answers, unpacked,
)
from threadlens.operators.ranking import top_n_per_group

LONGEST = 4
BUDGET = 500_000  # suffixes of a group
MOST_PREFIXES = 1_000_000
SLICE_BYTES = 2_000_000  # of text; its suffixes take about 30 times as much memory
BUCKET_BYTES = 24_000_000  # of text; a bucket counts the words whose hash names it
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
NO_LANGUAGE = "und"
_END = "\n"  # stands where a piece ends; no word can have it


class Slice:
    """The words of some documents, one after the other, as numbers of the slice's own (language, word) pairs."""

    def __init__(self, rows: pa.Table):
        texts = rows.column("body").combine_chunks()
        coded = pc.fill_null(rows.column("lang").combine_chunks(), NO_LANGUAGE).dictionary_encode()
        self.langs = coded.dictionary
        lang = np.asarray(coded.indices, np.int64)
        texts = pc.replace_substring(pc.ascii_lower(pc.fill_null(texts, "")), "\t", " ")
        texts = pc.replace_substring_regex(texts, PIECE_ENDS, f" {_END} ")
        lists = pc.split_pattern(pc.binary_join_element_wise(texts, pa.scalar(_END), pa.scalar(" ")), " ")
        words, counts = lists.flatten(), np.diff(np.asarray(lists.offsets))
        lang = np.repeat(lang, counts)
        full = pc.greater(pc.binary_length(words), 0)
        words, lang = words.filter(full), lang[np.asarray(full)]
        coded = words.dictionary_encode()
        pair = lang * (len(coded.dictionary) + 1) + np.asarray(coded.indices)
        pairs, self.word = np.unique(pair, return_inverse=True)
        self.pair_lang, which = np.divmod(pairs, len(coded.dictionary) + 1)
        self.pair_word = coded.dictionary.take(pa.array(which))
        self.ends = np.asarray(pc.equal(self.pair_word, _END), bool)
        self.times = np.bincount(self.word, minlength=len(pairs))
        self.mark = checksum(self.word, self.times)

    def asked(self, buckets: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """Bucket, language and pairs of the slice, for each bucket and language that it has words for."""
        marks = np.array([xxhash.xxh64_intdigest(w) for w in self.pair_word.cast(pa.binary()).to_pylist()], np.uint64)
        bucket = (mixed(marks) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((self.pair_lang, bucket))
        order = order[~self.ends[order]]
        for own in np.split(order, np.flatnonzero(
            (bucket[order][1:] != bucket[order][:-1]) | (self.pair_lang[order][1:] != self.pair_lang[order][:-1])) + 1):
            if len(own):
                yield int(bucket[own[0]]), int(self.pair_lang[own[0]]), own

    def numbered(self, answers: pa.Table | None, starts: dict[int, tuple[int, int]]) -> Suffixes:
        """The words by their numbers in the whole table; 0 for rare words and ends of pieces."""
        number, before, times = (np.zeros(len(self.times), np.int64) for _ in range(3))
        if answers is not None:
            pair, row = unpacked(answers.column("pairs"), "<u4")
            first = np.array([starts[b] for b in answers.column("bucket").to_pylist()], np.int64)[row]
            number[pair] = unpacked(answers.column("numbers"), "<u4")[0] + first[:, 0] + 1
            before[pair] = unpacked(answers.column("before"), "<i8")[0] + first[:, 1]
            times[pair] = unpacked(answers.column("times"), "<i8")[0]
        return Suffixes(number[self.word], before[self.word], times[self.word])


class Suffixes:
    """The distinct suffixes of at least two words, cut off after ``LONGEST``, in order, with their counts."""

    def __init__(self, number: np.ndarray, before: np.ndarray, times: np.ndarray):
        padded = np.concatenate([number, np.zeros(LONGEST, np.int64)])
        starts = np.flatnonzero((padded[:-LONGEST] > 0) & (padded[1:1 - LONGEST] > 0))
        words = [padded[starts]]
        for j in range(1, LONGEST):
            words.append(np.where(words[-1] > 0, padded[starts + j], 0))
        high, low = (words[0] << 32) | words[1], (words[2] << 32) | words[3]
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])) if len(order) else order
        self.words = [w[order][new] for w in words]
        self.counts = np.diff(np.append(new, len(order)))
        self.before, self.times = (a[starts][order][new] for a in (before, times))
        known, first = np.unique(number, return_index=True)
        self.known, self.known_times = known, times[first]


class Prefixes:
    """The prefixes beyond the budget, by their number of words, and how many groups each is dealt to."""

    def __init__(self, budget: int):
        self.budget = budget
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # sorted codes of two words and more, and their counts

    def extend(self, rows: Sequence[tuple]) -> None:
        """Add the next length: rows of words and count, whose first words are extended themselves."""
        codes = [(self._code([np.array([w]) for w in r[:-1]])[0], r[-1]) for r in rows]
        codes.sort()
        self.levels.append((np.array([c for c, _ in codes], np.int64), np.array([n for _, n in codes], np.int64)))

    def _code(self, words: list[np.ndarray]) -> np.ndarray:
        """One number for a prefix: the place of its first words among the extended ones, and its last word."""
        code = words[0]
        for level, word in enumerate(words[1:]):
            first = code if level == 0 else np.searchsorted(self.levels[level - 1][0], code)
            code = (first << 32) | word
        return code

    def extended(self, words: list[np.ndarray], times: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For one word, two words and so on: whether that prefix is beyond the budget, and its count."""
        found = [(times > self.budget, times)]
        code = words[0]
        for level, (codes, counts) in enumerate(self.levels):
            first = code if level == 0 else place
            code = (first << 32) | words[level + 1]
            place = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
            same = found[-1][0] & (codes[place] == code if len(codes) else False)
            found.append((same, np.where(same, counts[place] if len(codes) else 0, 0)))
        return found

    def groups(self, suffixes: Suffixes) -> np.ndarray:
        """The group of each suffix: that of its longest prefix all of whose beginnings are extended."""
        group = suffixes.before // self.budget
        for level, (beyond, count) in enumerate(self.extended(suffixes.words, suffixes.times)):
            if level + 1 >= LONGEST:
                break
            seed = np.zeros(len(group), np.uint64)
            for word in suffixes.words[: level + 2]:
                seed = mixed(seed + word.astype(np.uint64))
            begun = np.zeros(len(group), np.uint64)
            for word in suffixes.words[: level + 1]:
                begun = mixed(begun + word.astype(np.uint64))
            dealt = seed % np.maximum(2 * (count // self.budget + 1), 1).astype(np.uint64)
            # beyond the numbers of the other groups; should two prefixes share one, its counts are right all the same
            code = ((begun + dealt) >> np.uint64(3)).astype(np.int64) | (1 << 61)
            group = np.where(beyond, code, group)
        return group

    def depth(self, suffixes: Suffixes) -> np.ndarray:
        """How many of a suffix's beginnings are extended."""
        return sum(beyond.astype(np.uint8) for beyond, _ in self.extended(suffixes.words, suffixes.times))


ASKED = "part int, slice bigint, mark bigint, bucket int"
COUNTED = f"{ASKED}, pairs binary, numbers binary, before binary, times binary, lang string, first bigint, words array<string>, counts array<bigint>, occurrences bigint"
WORDS = [f"w{j + 1}" for j in range(LONGEST)]
NODE = ", ".join(f"{w} bigint" for w in WORDS) + ", a bigint"


def _ask_words(buckets: int):
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in slices(batches, "body", SLICE_BYTES):
            own = Slice(rows)
            found = [
                (partition(), number, own.mark, bucket, own.langs[lang].as_py(), _END.join(own.pair_word.take(pa.array(pairs)).to_pylist()),
                 pairs.astype(np.uint32).tobytes(), own.times[pairs].astype(np.uint32).tobytes())
                for bucket, lang, pairs in own.asked(buckets)
            ]
            if found:
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.binary(), pa.binary())
                names = ("part", "slice", "mark", "bucket", "lang", "words", "pairs", "times")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)
        release()

    return ask


def _count_words(least: int):
    """Function for all questions of a bucket: answers to the slices, and the bucket's words, one row per language.

    Rows of words have a negative ``part``, so that they are stored apart from the answers.
    """

    def count(table: pa.Table) -> pa.Table:
        lists = pc.split_pattern(table.column("words").combine_chunks(), _END)
        coded = lists.flatten().dictionary_encode()
        row = np.repeat(np.arange(table.num_rows), np.diff(np.asarray(lists.offsets)))
        langs = table.column("lang").combine_chunks().dictionary_encode()
        pair = np.asarray(langs.indices, np.int64)[row] * len(coded.dictionary) + np.asarray(coded.indices)
        asked, times = (unpacked(table.column(n), "<u4")[0] for n in ("pairs", "times"))
        pairs, at = np.unique(pair, return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, at, times)
        keep = total >= least
        number, ends = np.cumsum(keep) - 1, np.cumsum(np.where(keep, total, 0))
        chosen = np.flatnonzero(keep[at])
        mine = at[chosen]
        rows, sizes = np.unique(row[chosen], return_counts=True)
        answers = table.take(pa.array(rows)).select(["part", "slice", "mark", "bucket"])
        values = {"pairs": asked[chosen], "numbers": number[mine].astype(np.uint32), "before": (ends - total)[mine], "times": total[mine]}
        for name, each in values.items():
            answers = answers.append_column(name, packed(each, sizes))
        lang, word = np.divmod(pairs, len(coded.dictionary))
        listed = []
        bucket = table.column("bucket")[0].as_py()
        for code, name in enumerate(langs.dictionary.to_pylist()):
            here = lang == code
            kept = np.flatnonzero(here & keep)
            listed.append({
                "part": -1 - bucket, "bucket": bucket, "lang": name, "first": int(number[kept[0]]) if len(kept) else 0,
                "words": coded.dictionary.take(pa.array(word[kept])).to_pylist(), "counts": total[kept].tolist(),
                "occurrences": int(total[here].sum()),
            })
        listed = pa.Table.from_pylist(listed, _COUNTED)
        return pa.concat_tables([answers.select([c for c in _COUNTED.names if c in answers.column_names]), listed], promote_options="default").select(
            _COUNTED.names).cast(_COUNTED)

    return count


_COUNTED = pa.schema([
    ("part", pa.int32()), ("slice", pa.int64()), ("mark", pa.int64()), ("bucket", pa.int32()), ("pairs", pa.binary()),
    ("numbers", pa.binary()), ("before", pa.binary()), ("times", pa.binary()), ("lang", pa.string()), ("first", pa.int64()),
    ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("occurrences", pa.int64()),
])


def _suffixes(batches: Iterable[pa.RecordBatch], counted: str, starts: dict[int, tuple[int, int]]) -> Iterator[Suffixes]:
    """The suffixes of each slice, from the words' numbers that were stored for it."""
    answers = read_answers(counted, partition(), ["bucket", "pairs", "numbers", "before", "times"])
    for number, rows in slices(batches, "body", SLICE_BYTES):
        if number in answers:
            own = Slice(rows)
            yield own.numbered(answers_for(answers, number, own.mark), starts)
    release()


def _longer_prefixes(rows: DataFrame, counted: str, starts: dict, prefixes: Prefixes) -> list[tuple]:
    """Prefixes one word longer than the longest extended ones, if they have more occurrences than the budget."""
    length = len(prefixes.levels) + 2

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _suffixes(batches, counted, starts):
            # a prefix beyond the budget has no word that is within it
            often = found.known[found.known_times > prefixes.budget]
            chosen = (prefixes.depth(found) >= length - 1) & np.isin(found.words[length - 1], often)
            words, n = [w[chosen] for w in found.words[:length]], found.counts[chosen]
            if len(n):  # the suffixes are in order, so equal beginnings follow each other
                new = np.flatnonzero(np.concatenate([[True], np.any([w[1:] != w[:-1] for w in words], axis=0)]))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(w[new]) for w in words], pa.array(np.add.reduceat(n, new))], names=[*WORDS[:length], "n"])

    schema = ", ".join(f"{w} bigint" for w in WORDS[:length]) + ", n bigint"
    totals = rows.mapInArrow(count, schema).groupBy(*WORDS[:length]).agg(F.sum("n").alias("n"))
    # at most MOST_PREFIXES rows, by the choice of the budget
    return [tuple(r) for r in totals.filter(F.col("n") > prefixes.budget).collect()]


def _ask_nodes(counted: str, starts: dict, prefixes: Prefixes):
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _suffixes(batches, counted, starts):
            group = prefixes.groups(found)
            order = np.argsort(group, kind="stable")
            groups, sizes = np.unique(group, return_counts=True)
            planes = [w.astype(np.uint32) for w in found.words]
            planes += [found.counts.astype(np.uint32), prefixes.depth(found)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups, pa.int64()), *[packed(p[order], sizes) for p in planes]], names=["group", *WORDS, "n", "depth"])

    return ask


def _subtree(least: int):
    """Function for all suffixes of a group: the nodes of its subtree that occur often enough, below the extended prefixes."""

    def build(table: pa.Table) -> pa.Table:
        words = [unpacked(table.column(w), "<u4")[0].astype(np.int64) for w in WORDS]
        n, depth = unpacked(table.column("n"), "<u4")[0].astype(np.int64), unpacked(table.column("depth"), "u1")[0]
        order = np.lexsort(((words[2] << 32) | words[3], (words[0] << 32) | words[1]))
        words, n, depth = [w[order] for w in words], n[order], depth[order]
        new = np.zeros(len(n), bool)
        new[:1] = True
        new[1:] = words[0][1:] != words[0][:-1]
        out = []
        for length in range(2, LONGEST + 1):
            own = words[length - 1]
            new[1:] |= own[1:] != own[:-1]
            heads = np.flatnonzero(new)
            total = np.add.reduceat(n, heads)
            chosen = (own[heads] > 0) & (depth[heads] < length) & (total >= least)
            heads = heads[chosen]
            node = [w[heads] if j < length else np.zeros(len(heads), np.int64) for j, w in enumerate(words)]
            out.append(pa.table([*node, total[chosen]], names=[*WORDS, "a"]))
        return pa.concat_tables(out)

    return build


def frequent_phrases(
    docs: DataFrame, *, least: int = 30, text: str = "text", lang: str = "lang", budget: int = BUDGET, from_files: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three stored tables: words (``id``, ``lang``, ``word``, ``a``), phrases of two words and more (``w1`` to ``w4``, 0 where
    there is none, and ``a``), and languages (``lang``, ``n``). ``docs`` is read three to five times; see ``slices.py``.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("body"))
    if not from_files:
        rows = stored(rows, "texts")
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, size // BUCKET_BYTES + 1)
    question = f"{ASKED}, lang string, words string, pairs binary, times binary"
    asked = rows.mapInArrow(_ask_words(buckets), question)
    counted = store_answers(asked.groupBy("bucket").applyInArrow(_count_words(least), COUNTED), "word-counts")
    schema = COUNTED.replace("part int, ", "") + ", part int"
    listed = spark.read.schema(schema).parquet(counted).filter("part < 0").select("bucket", "lang", "first", "words", "counts", "occurrences")
    languages = stored(listed.groupBy("lang").agg(F.sum("occurrences").alias("n")), "languages")
    of_bucket = listed.groupBy("bucket").agg(
        F.sum(F.size("words")).alias("words"), F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda x, y: x + y)).alias("times"))
    starts, n_words, n_times = {}, 0, 0
    for r in of_bucket.orderBy("bucket").collect():  # a row for each bucket of texts
        starts[r["bucket"]] = (n_words, n_times)
        n_words, n_times = n_words + r["words"], n_times + r["times"]
    if n_words >= 1 << 31:
        raise ValueError(f"{n_words} words occur {least} times or more; numbers have 31 bits")
    first = spark.createDataFrame([(b, s[0]) for b, s in starts.items()], "bucket int, start bigint")
    each = F.posexplode(F.arrays_zip("words", "counts")).alias("at", "e")
    words = stored(
        listed.join(F.broadcast(first), "bucket").select("lang", (F.col("start") + F.col("first")).alias("from"), each)  # a row per bucket
        .select((F.col("from") + F.col("at") + 1).alias("id"), "lang", F.col("e.words").alias("word"), F.col("e.counts").alias("a")),
        "words",
    )
    prefixes, beyond = Prefixes(max(budget, n_times // MOST_PREFIXES)), []
    many = words.filter(F.col("a") > prefixes.budget).limit(1).count()
    while many and len(prefixes.levels) < LONGEST - 2:
        found = _longer_prefixes(rows, counted, starts, prefixes)
        prefixes.extend(found)
        beyond += [(*r[:-1], *[0] * (LONGEST + 1 - len(r)), r[-1]) for r in found]
        many = len(found)
    suffixes = rows.mapInArrow(
        _ask_nodes(counted, starts, prefixes), "group bigint, " + ", ".join(f"{w} binary" for w in WORDS) + ", n binary, depth binary")
    nodes = suffixes.groupBy("group").applyInArrow(_subtree(least), NODE)
    if beyond:
        nodes = nodes.unionByName(spark.createDataFrame(beyond, NODE))
    return words, stored(nodes, "phrases"), languages


def _key(words: Sequence) -> list:
    """A phrase's words in the columns of a table of phrases, 0 after the last."""
    return [*words, *[F.lit(0).cast("bigint")] * (LONGEST - len(words))]


def _named(words: Sequence, **more) -> F.Column:
    return F.struct(*[c.alias(w) for w, c in zip(WORDS, _key(words))], *[c.alias(n) for n, c in more.items()])


def scored_phrases(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases with ``l``, ``r`` and ``score`` of the cut with the lowest score."""
    every = phrases.unionByName(words.select(*[c.alias(w) for w, c in zip(WORDS, _key([F.col("id")]))], "a"))
    own, lengths = [F.col(w) for w in WORDS], range(2, LONGEST + 1)
    length = sum((F.col(w) > 0).cast("int") for w in WORDS)
    cuts = F.filter(F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(k).alias("k"), _named(own[:k]).alias("first"), _named(own[k:m]).alias("rest"))
        for m in lengths for k in range(1, m)
    ]), lambda c: c["m"] == length)
    cut = phrases.select(*WORDS, "a", F.explode(cuts).alias("c")).select(*WORDS, "a", "c.k", "c.first", "c.rest")
    counts = every.select(F.struct(*WORDS).alias("part"), F.col("a").alias("times"))
    left, right = counts.toDF("first", "l"), counts.toDF("rest", "r")
    both = cut.join(left, "first").join(right, "rest")
    times = F.expr("CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) DIV (CAST(l AS DECIMAL(19, 0)) + r)")
    lowest = F.min(F.struct(times.alias("score"), "k", "l", "r")).alias("low")
    return both.groupBy(*WORDS, "a").agg(lowest).select(*WORDS, "a", "low.l", "low.r", "low.score")


def drop_contained(scored: DataFrame, phrases: DataFrame, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """Phrases that lie in no longer phrase with at least that share of their occurrences."""
    own = [F.col(w) for w in WORDS]
    inner = [(m, i, k) for m in range(3, LONGEST + 1) for k in range(2, m) for i in range(m - k + 1)]
    length = sum((F.col(w) > 0).cast("int") for w in WORDS)
    parts = F.filter(F.array(*[_named(own[i:i + k], m=F.lit(m)) for m, i, k in inner]), lambda c: c["m"] == length)
    longer = phrases.filter(F.col(WORDS[2]) > 0).select(F.col("a").alias("longer"), F.inline(parts))
    most = longer.groupBy(*WORDS).agg(F.max("longer").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    inside = F.coalesce(wide("longer") * share[1] >= wide("a") * share[0], F.lit(False))
    return scored.join(most, WORDS, "left").filter(~inside).drop("longer")


def collocations(
    docs: DataFrame, *, least: int = 30, top: int = 2000, text: str = "text", lang: str = "lang", budget: int = BUDGET,
    from_files: bool = False,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    By score, then a (both descending), then the phrase's bytes. All phrases that share the last place's score and a are
    compared by their words.
    """
    words, phrases, languages = frequent_phrases(docs, least=least, text=text, lang=lang, budget=budget, from_files=from_files)
    kept = drop_contained(scored_phrases(words, phrases), phrases)
    named = kept.join(words.select(F.col("id").alias("w1"), "lang", F.col("word").alias("t1")), "w1")
    order = [F.desc("score"), F.desc("a")]
    for by in (["lang", F.pmod(F.xxhash64(*WORDS), F.lit(64))], ["lang"]):  # few rows of a part reach the second step
        named = named.withColumn("place", F.rank().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("place") <= top).drop("place")
    for j in range(2, LONGEST + 1):
        named = named.join(words.select(F.col("id").alias(f"w{j}"), F.col("word").alias(f"t{j}")), f"w{j}", "left")
    spelled = named.withColumn("phrase", F.concat_ws(" ", *[f"t{j}" for j in range(1, LONGEST + 1)]))
    ranked = top_n_per_group(spelled.select("lang", "phrase", "a", "l", "r", "score"), ["lang"], [*order, F.col("phrase")], top, "rank")
    return ranked.join(languages, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
