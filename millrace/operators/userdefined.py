"""User-defined aggregates and table aggregates written in Python.

Both run in two phases. Each task folds its own rows into states, one per key;
only states are shuffled, and they are merged one after another from sorted
input. A key with a third of all rows therefore costs the second phase one
small state per task, and memory holds one key at a time.
"""

from __future__ import annotations

import heapq
from collections import namedtuple
from collections.abc import Iterable, Iterator, Sequence
from operator import add, attrgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.operators.windows import window_bounds

# States a task holds before it passes them on as they are.
KEYS_IN_MEMORY = 100_000
ROWS_PER_BATCH = 10_000


class Aggregate:
    """Subclass this. States are lists, changed in place.

    ``state_type`` is the DDL of a STRUCT or ARRAY that holds a state,
    ``result_type`` that of the result fields, such as ``cnt BIGINT``.
    """

    state_type: str
    result_type: str

    def zero(self) -> list:
        """The state of no rows."""
        raise NotImplementedError

    def step(self, state: list, row, sign: int) -> None:
        """Count a row in (``sign`` 1) or, on a change log, out again (-1)."""
        raise NotImplementedError

    def merge(self, state: list, other: list) -> None:
        """Take in what another task has gathered for the same key."""
        raise NotImplementedError

    def rows(self, key: tuple, state: list) -> Iterable[tuple]:
        """Result rows: one for an aggregate, any number for a table aggregate."""
        yield tuple(state)


def _batches(rows: Iterable[list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    pending: list[list] = []

    def build() -> pa.RecordBatch:
        columns = [pa.array(c, type=f.type) for c, f in zip(zip(*pending), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row in rows:
        pending.append(row)
        if len(pending) >= ROWS_PER_BATCH:
            yield build()
            pending = []
    if pending:
        yield build()


def comparable(key: Column, kind: T.DataType) -> Column:
    """The key with one zero and one NaN, also inside structs and arrays, as grouping in Spark has it."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(key), F.lit(float("nan"))).otherwise(key + F.lit(0.0)).cast(kind)
    if isinstance(kind, T.StructType):
        inner = F.struct(*[comparable(key.getField(f.name), f.dataType).alias(f.name) for f in kind])
        return F.when(key.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(key, lambda x: comparable(x, kind.elementType))
    return key


def frozen(key):
    """A hashable form of a key, in which NaN equals itself."""
    if isinstance(key, dict):
        return tuple((k, frozen(v)) for k, v in key.items())
    if isinstance(key, (list, tuple)):
        return tuple(map(frozen, key))
    return "NaN" if isinstance(key, float) and key != key else key


def state_codec(state_type: T.DataType):
    """State lists to and from their column form."""
    if isinstance(state_type, T.StructType):
        names = state_type.names
        return (lambda state: dict(zip(names, state))), (lambda stored: [stored[n] for n in names])
    return list, list


def partial_aggregate(
    df: DataFrame, keys: Sequence[str], fn: Aggregate, inputs: Sequence[str], op: str | None = None
) -> DataFrame:
    """First phase: keys and a ``state`` column, a key at most once per flush of a task."""
    if not keys:
        raise ValueError("name at least one key column")
    same = [comparable(F.col(k), df.schema[k].dataType).alias(k) for k in keys]
    wanted = df.select(*same, *inputs, *([op] if op else []))
    state_type = T.DataType.fromDDL(fn.state_type)
    schema = T.StructType([*[wanted.schema[k] for k in keys], T.StructField("state", state_type)])
    arrow = to_arrow_schema(schema)
    pack, _ = state_codec(state_type)
    n, m = len(keys), len(inputs)
    Input = namedtuple("Input", inputs)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def partials():
            held: dict[tuple, tuple[tuple, list]] = {}
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                ops = columns[n + m] if op else None
                key_rows = list(zip(*columns[:n]))
                rows = zip(*columns[n:n + m]) if m else [()] * len(key_rows)
                for i, (key, row) in enumerate(zip(key_rows, rows)):
                    entry = held.get(frozen(key))
                    if entry is None:
                        entry = held[frozen(key)] = key, fn.zero()
                    fn.step(entry[1], Input._make(row), -1 if ops and ops[i].startswith("-") else 1)
                if len(held) > KEYS_IN_MEMORY:
                    yield from ([*k, pack(s)] for k, s in held.values())
                    held = {}
            yield from ([*k, pack(s)] for k, s in held.values())

        yield from _batches(partials(), arrow)

    return wanted.mapInArrow(fold, schema)


def aggregate(
    df: DataFrame, keys: Sequence[str], fn: Aggregate, inputs: Sequence[str], op: str | None = None
) -> DataFrame:
    """Key columns and the result fields of ``fn`` over the ``inputs`` columns.

    With ``op`` naming a change-log column, rows whose op starts with ``-``
    are retracted.
    """
    partial = partial_aggregate(df, keys, fn, inputs, op)
    _, unpack = state_codec(partial.schema["state"].dataType)
    schema = T.StructType([*partial.schema.fields[:-1], *T.DataType.fromDDL(fn.result_type).fields])
    arrow = to_arrow_schema(schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged():
            current, state = None, None
            for batch in batches:
                for *key, stored in zip(*[c.to_pylist() for c in batch.columns]):
                    if current is None or frozen(key) != frozen(current):
                        if current is not None:
                            yield from ([*current, *r] for r in fn.rows(tuple(current), state))
                        current, state = key, fn.zero()
                    fn.merge(state, unpack(stored))
            if current is not None:
                yield from ([*current, *r] for r in fn.rows(tuple(current), state))

        yield from _batches(merged(), arrow)

    by_key = partial.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return by_key.mapInArrow(finish, schema)


def with_window_bounds(
    df: DataFrame, keys: Sequence[str], time: str, size: str, inputs: Sequence[str]
) -> DataFrame:
    window = F.window(time, size)
    return df.select(*keys, *[c for c in inputs if c not in keys], *window_bounds(window))


def window_process(
    df: DataFrame, keys: Sequence[str], time: str, size: str, fn: Aggregate, inputs: Sequence[str]
) -> DataFrame:
    """``fn`` per key and tumbling window; ``rows`` gets the bounds in its key.

    The key passed to ``rows`` is (keys..., start ms, end ms).
    """
    bounded = with_window_bounds(df, keys, time, size, inputs)
    return aggregate(bounded, [*keys, "window_start", "window_end"], fn, inputs)


class CountSum(Aggregate):
    """Rows and the sum of an integer field, given as text or number."""

    state_type = "STRUCT<cnt: BIGINT, sum: BIGINT>"
    result_type = "cnt BIGINT, sum BIGINT"

    def __init__(self, field: str):
        self.value = attrgetter(field)

    def zero(self):
        return [0, 0]

    def step(self, state, row, sign):
        state[0] += sign
        state[1] += sign * int(self.value(row))

    def merge(self, state, other):
        state[:] = map(add, state, other)


class Largest(Aggregate):
    """The ``n`` largest values of an integer field; zeros take a place unseen.

    What fell out of the list is not known, so it takes no change log; for
    those see ``top_of_changes``, on tables and on streams.
    """

    state_type = "ARRAY<BIGINT>"

    def __init__(self, field: str, n: int = 2):
        self.field, self.n = field, n
        self.result_type = f"{field} BIGINT"

    def zero(self):
        return []

    def step(self, state, row, sign):
        if sign < 0:
            raise ValueError("rows cannot be taken back from the largest values")
        self.merge(state, [int(getattr(row, self.field))])

    def merge(self, state, other):
        state[:] = heapq.nlargest(self.n, [*state, *other])

    def rows(self, key, state):
        return [(v,) for v in state if v]


class WindowCount(Aggregate):
    """Elements of a window."""

    state_type = "ARRAY<BIGINT>"
    result_type = "cnt BIGINT"

    def zero(self):
        return [0]

    def step(self, state, row, sign):
        state[0] += sign

    def merge(self, state, other):
        state[0] += other[0]
