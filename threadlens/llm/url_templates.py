"""URL filters: rules for hosts and paths, and a path-template tree per host judged by labelled purity.

A url's path is cut into segments in which every run of digits becomes ``#``. From the root of each host down,
a node's children are merged, in the order of their shares of bad labels, where a test of two proportions at ``z`` does
not tell them apart. With up to ``most_children`` children, each is tested against its neighbour. With more, those with
fewer than ``support`` labels become one wildcard, as chance would tell some of them apart; all others are tested, however
many they are: by shares rounded to a thousandth, each against all of the branch so far. What is left from the root to a leaf is the template. Its share of bad labels is smoothed with the weight
of ``prior`` urls towards the host's share, which is smoothed towards the share of all; templates at ``reject`` or
above are blocked.

The tree works on distinct (host, path shape) rows with counts, made by one aggregation with partial sums, so a
host with a third of all urls is a few rows. A round folds the segments that all rows of a node share, branches once and
drops rows whose path has ended, so there are as many rounds as branchings on a path, and paths are never cut.

Null urls and those without ``://`` have an empty host and path and get the template of that host. Without labels
nothing is blocked but by rules. Repeated rows count as often as they come. Empty tables give no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from threadlens.llm.common import ascii_lower, stored

LEAF, WILD, MERGED = "", "*", "~"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty for null or without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """Rule (such as ``net/``) and verdict of the longest fitting rule, else null.

    ``rules`` is a short list of (verdict, host and path). A rule fits its host and all subdomains if the path
    starts with the rule's.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for given, rule in sorted(rules, key=lambda r: len(r[1])):  # longer ones go on top
        top, slash, rest = rule.partition("/")
        fits = ((host == top) | host.endswith("." + top)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, given).otherwise(verdict)
    return name, verdict


def shape(path: Column) -> Column:
    return F.regexp_replace(path, "[0-9]+", "#")


def build_templates(
    labelled: DataFrame, *, most_children: int = 16, support: int = 10, z: float = 1.96,
) -> DataFrame:
    """``template`` and counts (``n``, ``n_labelled``, ``n_bad``) of each (``host``, ``shape``).

    ``labelled`` has a row per url: ``host``, ``path`` and ``bad`` (1, 0, or null without a label).
    """
    bad = F.col("bad").cast("bigint")
    shapes = labelled.groupBy("host", shape(F.col("path")).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.count(bad).alias("n_labelled"), F.coalesce(F.sum(bad), F.lit(0)).alias("n_bad"))
    rows = stored(shapes.withColumn("parts", F.split("shape", "/")).withColumn("template", F.lit("")), "url-shapes")
    counts, ended = ("n", "n_labelled", "n_bad"), F.size("parts") == 0
    done: list[DataFrame] = [rows.filter(ended)]
    rows = rows.filter(~ended)
    while not rows.isEmpty():
        folded = _folded(rows)
        at = folded.filter(~ended).withColumn("child", F.get("parts", F.lit(0)))
        children = stored(
            at.groupBy("host", "template", "child").agg(*[F.sum(c).alias(c) for c in counts]), "url-children")
        nodes = children.groupBy("host", "template").agg(F.count(F.lit(1)).alias("n_children"))
        each = children.join(stored(nodes, "url-nodes"), ["host", "template"])
        many, enough = F.col("n_children") > most_children, F.col("n_labelled") >= support
        wild = each.filter(many & ~enough).select("host", "template", "child", F.lit(WILD).alias("branch"))
        named = wild.unionByName(_merged(each.filter(~many), z)).unionByName(_merged_bins(each.filter(many & enough), z))
        grown = at.join(stored(named, "url-branches"), ["host", "template", "child"]).withColumn(
            "template", F.concat("template", F.lit("/"), "branch")).withColumn("parts", F.slice("parts", 2, F.size("parts")))
        grown = stored(grown.select(*rows.columns), "url-shapes")
        done += [folded.filter(ended), grown.filter(ended)]
        if len(done) > 32:  # the plan does not grow with the rounds
            done = [stored(reduce(DataFrame.unionByName, done), "url-ended")]
        rows = grown.filter(~ended)
    return reduce(DataFrame.unionByName, done).drop("parts")


def _folded(rows: DataFrame) -> DataFrame:
    """The rows with the segments that all rows of their node begin with moved from ``parts`` to the template."""
    node = ["host", "template"]
    ends = rows.groupBy(*node).agg(F.min("parts").alias("low"), F.max("parts").alias("high"))
    unlike = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), F.lit(False))
    shared = F.when(unlike > 0, unlike - 1).otherwise(F.size("low")).cast("int")  # what the first and the last share, all do
    ends = stored(ends.select(*node, shared.alias("shared")), "url-shared")
    more = F.concat("template", F.lit("/"), F.array_join(F.slice("parts", F.lit(1), F.col("shared")), "/"))
    return stored(
        rows.join(ends, node)
        .withColumn("template", F.when(F.col("shared") > 0, more).otherwise(F.col("template")))
        .withColumn("parts", F.slice("parts", F.col("shared") + 1, F.size("parts"))).select(*rows.columns), "url-shapes")


def _merged_bins(children: DataFrame, z: float) -> DataFrame:
    """The branch of each well-supported child of nodes with many children.

    Children of about the same share are one bin, so a node has at most 1,001 of them. In order, a bin begins a new
    branch where a test of two proportions tells it from the branch before. A child alone keeps its name.
    """
    node = ["host", "template"]
    binned = children.withColumn("bin", F.round(1000 * F.try_divide("n_bad", "n_labelled")).cast("bigint"))
    sums = binned.groupBy(*node, "bin").agg(*[F.sum(c).alias(c) for c in ("n_labelled", "n_bad")], F.count(F.lit(1)).alias("size"))
    listed = sums.groupBy(*node).agg(F.sort_array(F.collect_list(F.struct("bin", "n_labelled", "n_bad", "size"))).alias("bins"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, template, bins in zip(*(batch.column(i).to_pylist() for i in range(3))):
                parts = _branches([(b["n_labelled"], b["n_bad"]) for b in bins], z)
                sizes = Counter()
                for b, part in zip(bins, parts):
                    sizes[part] += b["size"]
                out += [(host, template, b["bin"], part, sizes[part] == 1) for b, part in zip(bins, parts)]
            types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
            columns = zip(*out) if out else [[] for _ in types]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types)], names=[*node, "bin", "part", "alone"])

    found = stored(listed.mapInArrow(cut, "host string, template string, bin bigint, part bigint, alone boolean"), "url-bins")
    name = F.when(F.col("alone"), F.col("child")).otherwise(F.concat(F.lit(MERGED), F.col("part").cast("string")))
    return binned.join(found, [*node, "bin"]).select(*node, "child", name.alias("branch"))


def _branches(bins: list[tuple[int, int]], z: float) -> list[int]:
    """The number of the branch of each (labelled, bad), in the order of their shares."""
    parts, part, all_n, all_bad = [], 0, 0, 0
    for n, bad in bins:
        if all_n:
            share = (all_bad + bad) / (all_n + n)
            if bad / n - all_bad / all_n > z * math.sqrt(share * (1 - share) * (1 / all_n + 1 / n)):
                part, all_n, all_bad = part + 1, 0, 0
        all_n, all_bad = all_n + n, all_bad + bad
        parts.append(part)
    return parts


def _merged(children: DataFrame, z: float) -> DataFrame:
    """The branch of each child of nodes with few children (so that a window sees few rows).

    In the order of their shares of bad labels, a child begins a new branch where a test of two proportions
    tells it from the one before. Children without labels are one branch. A child alone keeps its name.
    """
    node = ["host", "template"]
    rate = F.try_divide("n_bad", "n_labelled")
    in_order = W.partitionBy(*node, F.col("n_labelled") > 0).orderBy(rate, "child")
    last_n, last_bad = (F.lag(c).over(in_order) for c in ("n_labelled", "n_bad"))
    share = F.try_divide(last_bad + F.col("n_bad"), last_n + F.col("n_labelled"))
    spread = F.try_divide(F.lit(1), last_n) + F.try_divide(F.lit(1), F.col("n_labelled"))
    apart = rate - F.try_divide(last_bad, last_n) > z * F.sqrt(share * (1 - share) * spread)
    parts = children.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int")).withColumn(
        "part", F.when(F.col("n_labelled") > 0, F.sum("apart").over(in_order)).otherwise(-1))
    alone = F.count(F.lit(1)).over(W.partitionBy(*node, "part")) == 1
    name = F.when(alone, F.col("child")).otherwise(F.concat(F.lit(MERGED), F.col("part").cast("string")))
    return parts.select(*node, "child", name.alias("branch"))


def blocked_shapes(templates: DataFrame, *, prior: float = 10.0, reject: float = 0.5) -> DataFrame:
    """``host``, ``shape``, ``template``, its smoothed ``purity`` (share of bad) and ``blocked``."""
    leaves = stored(templates.groupBy("host", "template").agg(
        F.sum("n_labelled").alias("n_labelled"), F.sum("n_bad").alias("n_bad")), "url-templates")
    total = leaves.agg(F.sum("n_bad"), F.sum("n_labelled")).first()
    share = (total[0] or 0) / max(total[1] or 0, 1)
    hosts = leaves.groupBy("host").agg(
        ((F.sum("n_bad") + prior * share) / (F.sum("n_labelled") + prior)).alias("host_share"))
    judged = leaves.join(stored(hosts, "url-hosts"), "host").withColumn(
        "purity", (F.col("n_bad") + prior * F.col("host_share")) / (F.col("n_labelled") + prior))
    judged = stored(judged.select("host", "template", "purity", (F.col("purity") >= reject).alias("blocked")), "url-judged")
    return templates.select("host", "shape", "template").join(judged, ["host", "template"])


def judge_urls(
    labelled: DataFrame, rules: Sequence[tuple[str, str]] = (), *, key: str = "page_id", prior: float = 10.0,
    reject: float = 0.5, **tree,
) -> DataFrame:
    """Key, ``host``, ``path``, ``rule``, ``template``, ``purity`` and ``verdict`` of each row.

    ``labelled`` has the key, ``url`` and ``bad`` (1, 0, or null without a label).
    """
    host, path = host_and_path("url")
    rows = labelled.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"), F.col("bad").alias("bad"))
    rows = stored(rows.withColumn("shape", shape(F.col("path"))), "urls")
    found = stored(blocked_shapes(build_templates(rows, **tree), prior=prior, reject=reject), "url-verdicts")
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    by_tree = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(found, ["host", "shape"], "left").select(
        F.col("key").alias(key), "host", "path", rule.alias("rule"), "template", "purity",
        F.coalesce(verdict, by_tree).alias("verdict"),
    )
