"""Many groups to an Arrow batch: groups dealt by key, sorted inside partitions, handed on whole and together."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Rows that are handed on together, beyond one group.
TOGETHER = 20_000


def starts_of(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First rows of the runs of equal keys."""
    if not table.num_rows:
        return np.empty(0, np.int64)
    fresh = np.zeros(table.num_rows, bool)
    fresh[0] = True
    for key in keys:
        codes = table.column(key).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        fresh[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(fresh)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], together: int = TOGETHER) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(table, ends) of rows sorted by ``keys``: each table has whole groups, ``ends`` their first rows and the number of rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < together:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = starts_of(table, keys)
        last = int(starts[-1])
        if last:
            yield table.slice(0, last), starts
        rest = table.slice(last)
        held, size = rest.to_batches(), rest.num_rows
    if size:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.append(starts_of(table, keys), table.num_rows)


def by_groups(df: DataFrame, keys: list[str], order: list[str], run: Callable[[pa.Table, np.ndarray], pa.Table], schema: T.StructType | str) -> DataFrame:
    """``run`` over tables of whole groups, rows of a group in order. A group is in one task, as its state runs through it; a task has many."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ends in whole_groups(batches, keys):
            yield from run(table, ends).to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(apply, schema)
