"""Aggregates of the user's own, given as create, add, merge and result."""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wakeline.functions.timecols import floor_to, ms


class Aggregate(Protocol):
    """State must be picklable, and ``merge`` indifferent to order and grouping."""

    def create(self) -> Any: ...

    def add(self, state: Any, rows: pa.RecordBatch) -> Any:
        """The state with some rows of one key, which have all columns but the keys."""

    def merge(self, left: Any, right: Any) -> Any: ...

    def result(self, state: Any) -> tuple:
        """The values of the result columns."""


def aggregate(df: DataFrame, keys: dict[str, Column], values: dict[str, Column], how: Aggregate, result: str, room: int = 10_000) -> DataFrame:
    """``how`` over the rows of each key: the keys and the columns of ``result`` (a schema in text).

    Each task folds its own rows, so that a key costs one row per task before the shuffle; a task that holds more than
    ``room`` keys hands the states on and begins anew.  Behind the shuffle the states come sorted by key and are merged
    one after the other, so that no group is gathered, however many tasks held the key.  Null keys are a key; null values are
    for ``add`` to see; an empty table gives no rows.  Stored tables only.
    """
    names, inputs = list(keys), list(values)
    rows = df.select(*[c.alias(k) for k, c in keys.items()], *[c.alias(v) for v, c in values.items()])
    key_schema = StructType([rows.schema[k] for k in names])
    partial = StructType([*key_schema.fields]).add("state", "binary")
    out_schema = StructType([*key_schema.fields, *StructType.fromDDL(result).fields])
    out = to_arrow_schema(out_schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, Any] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            ordered = table.take(pc.sort_indices(table, [(k, "ascending") for k in names])).combine_chunks()
            tuples = list(zip(*[ordered[k].to_pylist() for k in names]))
            inner = ordered.select(inputs).to_batches()[0]
            first = 0
            for i in range(1, len(tuples) + 1):
                if i == len(tuples) or tuples[i] != tuples[first]:
                    key = tuples[first]
                    states[key] = how.add(states[key] if key in states else how.create(), inner.slice(first, i - first))
                    first = i
            if len(states) > room:
                yield _packed(states, batch.schema, names)
                states = {}
        if states:
            yield _packed(states, batch.schema, names)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for *now, packed in zip(*[c.to_pylist() for c in batch.columns]):
                if now == key:
                    state = how.merge(state, pickle.loads(packed))
                else:
                    if key is not None:
                        done.append((*key, *how.result(state)))
                    key, state = now, pickle.loads(packed)
            if len(done) > room:
                yield _rows(done, out)
                done = []
        if key is not None:
            done.append((*key, *how.result(state)))
        if done:
            yield _rows(done, out)

    states = rows.mapInArrow(fold, partial)
    return states.repartition(*names).sortWithinPartitions(*names).mapInArrow(merge, out_schema)


def _packed(states: dict[tuple, Any], schema: pa.Schema, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*states))
    arrays = [pa.array(columns[i], schema.field(k).type) for i, k in enumerate(names)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([pickle.dumps(s) for s in states.values()], pa.binary())], [*names, "state"])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class Quantile:
    """The least value that at least ``share`` of the non-null values do not exceed, exactly: counts per value."""

    def __init__(self, share: float, column: str):
        self.share = share
        self.column = column

    def create(self) -> Counter:
        return Counter()

    def add(self, state: Counter, rows: pa.RecordBatch) -> Counter:
        for c in pc.value_counts(rows.column(self.column).drop_null()).to_pylist():
            state[c["values"]] += c["counts"]
        return state

    def merge(self, left: Counter, right: Counter) -> Counter:
        left.update(right)
        return left

    def result(self, state: Counter) -> tuple:
        total, seen = sum(state.values()), 0
        for value in sorted(state):
            seen += state[value]
            if seen >= self.share * total:
                return value, total
        return None, total


def quantile_per_window(purchases: DataFrame, share: float, size: int, column: str = "amount_usd") -> DataFrame:
    """Quantile of the amounts of each window, as an aggregate of the kind above: window bounds, value, n."""
    found = aggregate(purchases.filter(F.col("ts").isNotNull()), {"window_start_ms": floor_to(ms(), size)}, {column: F.col(column)},
                      Quantile(share, column), "value double, n bigint")
    return found.select("window_start_ms", (F.col("window_start_ms") + size).alias("window_end_ms"), "value", "n")
