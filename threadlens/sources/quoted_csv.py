"""CSV with line breaks inside quotes, read by as many tasks as the files have splits.

Spark reads such files with ``multiLine``, one task per file, since a task that begins in the middle of a file cannot
tell whether it is inside quotes. Here a first pass over the lines finds, for each split, in which state it ends if
it begins outside quotes and if it begins inside. The driver, which holds the list of splits anyway, runs through
these two answers in the files' order and so knows the state at the beginning of every split. The second pass
puts lines together to records. A record that crosses the border of its split is put together from its pieces, which
are the only texts that are shuffled; if no split begins inside quotes there are none.

Lines come from Spark's text source, so any file system that Spark reads will do. Records are parsed by
``from_csv``, with the same rules as the CSV source.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTED = {"quote": '"', "escape": '"'}
_CLOSING = re.compile('[^"]*+(?:""[^"]*+)*+"')  # from inside quotes up to the quote that ends them


def inside_after(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether the end of a line is inside quotes. A quote opens only at the beginning of a field.

    What follows a closing quote belongs to the field up to the next separator, quotes included.
    """
    at = 0
    while True:
        if inside:
            closed = _CLOSING.match(line, at)
            if closed is None:
                return True
            inside, at = False, line.find(sep, closed.end())
            if at < 0:
                return False
            at += len(sep)
        if not line.startswith('"', at):
            at = line.find(sep + '"', at)
            if at < 0:
                return False
            at += len(sep)
        inside, at = True, at + 1


@dataclass(frozen=True)
class Split:
    """What is known of a split before its records are read."""

    inside: bool  # it begins inside quotes
    record: int  # the split in which the record begins that it then goes on with
    carriage: bool  # lines of its file end in a carriage return and a line feed


class _Records:
    """Puts the lines of one split together."""

    def __init__(self, split: Split, sep: str):
        self.inside, self.carriage, self.sep = split.inside, split.carriage, sep
        self.pending: list[str] = []
        self.begun = not split.inside  # whether the pending lines begin a record

    def feed(self, lines: pa.Array) -> tuple[str | None, pa.Array]:
        """The rest of the record that another split began, if it ends here, and the whole records."""
        if self.carriage:
            lines = pc.replace_substring_regex(lines, r"\r\z", "")
        ends, state, done = np.empty(len(lines), bool), self.inside, 0
        marked = np.flatnonzero(pc.match_substring(lines, '"'))
        for i, line in zip(marked.tolist(), lines.take(pa.array(marked)).to_pylist()):
            ends[done:i] = state
            state = inside_after(line, state, self.sep)
            ends[i], done = state, i + 1
        ends[done:] = state
        self.inside = state
        stops = np.flatnonzero(~ends) + 1
        if not len(stops):
            self.pending += lines.to_pylist()
            return None, pa.array([], pa.string())
        bounds = pa.array(np.concatenate([[0], stops]), pa.int32())
        records = pc.binary_join(pa.ListArray.from_arrays(bounds, lines.slice(0, int(stops[-1]))), "\n")
        if self.pending:
            first = "\n".join([*self.pending, records[0].as_py()])
            records = pa.concat_arrays([pa.array([first], pa.string()), records.slice(1)])
        rest = None
        if not self.begun:
            rest, records, self.begun = records[0].as_py(), records.slice(1), True
        self.pending = lines.slice(int(stops[-1])).to_pylist()
        return rest, records


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of each split in their order."""
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _by_split(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """Runs of lines of one split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(1).dictionary_encode(), batch.column(2).to_numpy()
        code = file.indices.to_numpy()
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield (file.dictionary[code[a]].as_py(), int(start[a])), batch.column(0).slice(a, b - a)


def _ends(sep: str):
    """Function for lines: per split, the end from outside and from inside, whether the latter is ever outside, and line ends."""

    def ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[bool]] = {}
        for split, lines in _by_split(batches):
            known = found.get(split)
            if known is None:
                first = lines[0].as_py()
                known = found[split] = [False, True, False, first.endswith("\r")]
            outer, inner = known[0], known[1]
            for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
                together = outer == inner
                outer = inside_after(line, outer, sep)
                inner = outer if together else inside_after(line, inner, sep)
                known[2] |= not inner
            known[0], known[1] = outer, inner
        if found:
            columns = [[f for f, _ in found], [s for _, s in found], *zip(*found.values())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["file", "start", "outer", "inner", "closes", "carriage"])

    return ends


def split_states(lines: DataFrame, sep: str = ",") -> tuple[dict[tuple[str, int], Split], bool]:
    """Each split's beginning, and whether any split or file ends inside quotes: one short row per split comes to the driver."""
    schema = "file string, start bigint, outer boolean, inner boolean, closes boolean, carriage boolean"
    splits: dict[tuple[str, int], Split] = {}
    file, inside, record, carriage, crossing = None, False, 0, False, False
    for r in sorted(lines.mapInArrow(_ends(sep), schema).collect(), key=lambda r: (r["file"], r["start"])):
        if r["file"] != file:
            file, inside, record, carriage = r["file"], False, 0, r["carriage"]
        splits[r["file"], r["start"]] = Split(inside, record, carriage)
        if not inside or r["closes"]:
            record = r["start"]
        inside = r["inner"] if inside else r["outer"]
        crossing |= inside
    return splits, crossing


def _put_together(splits: dict[tuple[str, int], Split], sep: str, header: bool, pieces: bool):
    """Function for lines: the records that lie in one split, or the pieces of those that do not."""

    def known(split: tuple[str, int]) -> Split:
        if split not in splits:
            raise RuntimeError("the files were split in another way than in the pass before")
        return splits[split]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["file", "record", "start", "text", "header"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, heading = None, None, False

        def last() -> Iterator[pa.RecordBatch]:
            """The beginning of a record that ends in another split, or the middle of one."""
            if pieces and own is not None and own.pending:
                record = at[1] if own.begun else known(at).record
                yield batch([(at[0], record, at[1], "\n".join(own.pending), own.begun and heading)])

        for split, lines in _by_split(batches):
            if split != at:
                yield from last()
                at, own = split, _Records(known(split), sep)
                heading = header and split[1] == 0
            rest, records = own.feed(lines)
            if pieces and rest is not None:
                yield batch([(split[0], known(split).record, split[1], rest, False)])
            records = records.filter(pc.not_equal(records, ""))
            if heading and len(records):
                records, heading = records.slice(1), False
            if not pieces and len(records):
                yield pa.RecordBatch.from_arrays([records], names=["text"])
        yield from last()

    return run


def read_records(spark: SparkSession, path: str | list[str], *, header: bool = True, sep: str = ",") -> DataFrame:
    """The records of CSV files as one column ``text``, without each file's first if it is a header."""
    lines = _lines(spark, path)
    splits, crossing = split_states(lines, sep)
    records = lines.mapInArrow(_put_together(splits, sep, header, False), "text string")
    if not crossing:
        return records
    schema = "file string, record bigint, start bigint, text string, header boolean"
    pieces = lines.mapInArrow(_put_together(splits, sep, header, True), schema)
    in_order = F.sort_array(F.collect_list(F.struct("start", "text")))  # the pieces of one record
    whole = pieces.groupBy("file", "record").agg(in_order.alias("pieces"), F.max("header").alias("header"))
    joined = F.array_join(F.transform("pieces", lambda p: p["text"]), "\n")
    return records.unionByName(whole.filter(~F.col("header")).select(joined.alias("text")))


def read_quoted_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, *, header: bool = True, sep: str = ",", **options: str,
) -> DataFrame:
    """A CSV table of a known schema whose texts may have line breaks and doubled quotes; every split is a task.

    Gives the rows that Spark's CSV source gives with ``multiLine``, in any order. Lines end in a line feed,
    with a carriage return before it or not. The files are read twice, and a third time if a split begins inside quotes.
    """
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    named = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parsed = F.from_csv("text", named, {**QUOTED, "sep": sep, **options})
    return read_records(spark, path, header=header, sep=sep).select(parsed.alias("r")).select("r.*")
