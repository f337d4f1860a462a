"""Work on runs of consecutive rows, and answers that each run reads back by itself.

A slice is a run of consecutive rows of one partition with a few megabytes of text. Operators that compare
all texts send what a slice holds in packed form (one row per slice and bucket instead of one per word) to
the task that sees all of the bucket, and store its answers by the partition that asked. A later pass over the same
rows reads the answers of its own partition from the shared folder, so texts are never shuffled.

The later pass must see the rows in the partitions and order of the first. Tables read from files do; others are
stored first. Each question carries a checksum of its slice's rows and each answer returns it: should the
order ever differ, the pass stops with an error instead of giving wrong results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from threadlens.session import scratch_path

SLICE_BYTES = 6_000_000

#: Odd constants that mix 64-bit numbers well (those of the SplitMix64 generator).
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def partition() -> int:
    """The number of the partition that the running task works on."""
    return TaskContext.get().partitionId()


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """Number and rows of each slice: whole rows until their texts pass ``most`` bytes."""
    waiting: list[pa.RecordBatch] = []
    size = number = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            stop = int(np.searchsorted(ends, before + most - size)) + 1
            part = batch.slice(begin, stop - begin)
            waiting.append(part)
            size += int(ends[begin + part.num_rows - 1]) - before
            begin += part.num_rows
            if size >= most:
                yield number, pa.Table.from_batches(waiting)
                waiting, size, number = [], 0, number + 1
    if waiting:
        yield number, pa.Table.from_batches(waiting)


def checksum(*arrays: np.ndarray) -> int:
    """A number that tells a slice's rows from others."""
    found = 0
    for values in arrays:
        found = zlib.crc32(np.ascontiguousarray(values).tobytes(), found)
    return found


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of texts, one after the other, and how many each text has."""
    trimmed = pc.ascii_trim_whitespace(texts)
    lists = pc.ascii_split_whitespace(trimmed)
    words, counts = lists.flatten(), np.diff(np.asarray(lists.offsets)).astype(np.int64)
    blank = np.asarray(pc.binary_length(trimmed)) == 0
    if blank.any():  # the split of a text without words is one empty word
        counts[blank] = 0
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return words, counts


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit number with all its bits spread over all bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of an array's items as binary values."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * values.dtype.itemsize
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), data]).cast(pa.binary())


def unpacked(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All items of packed values, and the row of each."""
    sizes = np.concatenate([np.zeros(0, np.int64), *[np.asarray(pc.binary_length(c), np.int64) for c in column.chunks]])
    values = np.concatenate([np.zeros(0, kind), *[np.frombuffer(b"".join(c.to_pylist()), kind) for c in column.chunks]])
    return values, np.repeat(np.arange(len(sizes)), sizes // np.dtype(kind).itemsize)


def store_answers(answers: DataFrame, name: str) -> str:
    """Write answers by the column ``part`` (the partition that asked) and return their folder."""
    path = scratch_path(answers.sparkSession, name)
    answers.repartition("part").write.partitionBy("part").parquet(path)
    return path


def read_answers(path: str, part: int, columns: list[str]) -> dict[int, pa.Table]:
    """The answers to a partition's questions by slice."""
    system, folder = arrow_fs.FileSystem.from_uri(path)
    found = system.get_file_info(arrow_fs.FileSelector(f"{folder}/part={part}", allow_not_found=True))
    names = sorted(f.path for f in found if f.path.endswith(".parquet"))
    if not names:
        return {}
    table = pa.concat_tables([pq.read_table(system.open_input_file(n), columns=["slice", "mark", *columns]) for n in names])
    numbers = table.column("slice").to_numpy()
    return {n: table.filter(pa.array(numbers == n)) for n in np.unique(numbers).tolist()}


def answers_for(answers: dict[int, pa.Table], number: int, mark: int) -> pa.Table | None:
    """The answers to one slice, which must be the slice that asked."""
    found = answers.get(number)
    if found is not None and set(found.column("mark").to_pylist()) != {mark}:
        raise RuntimeError("the rows came in another order than in the pass before; store the table first")
    return found
