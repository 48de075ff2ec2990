"""Python row functions, for logic that built-in functions cannot express."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_rows(df: DataFrame, fn: Callable[[dict], tuple], inputs: Sequence[str], result_type: str) -> DataFrame:
    """Replace every row by what ``fn`` makes of it, in Arrow batches.

    ``fn`` gets the ``inputs`` columns as a dict and returns the fields of
    ``result_type``; no other column leaves the JVM.
    """
    schema = T.DataType.fromDDL(result_type)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(zip(*[fn(row) for row in batch.to_pylist()])) or [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(made, arrow)], schema=arrow
            )

    return df.select(*inputs).mapInArrow(run, schema)


def row_udf(fn: Callable, return_type: str):
    """A scalar Python function as a column function, with Arrow transfer."""
    return F.udf(fn, returnType=return_type, useArrow=True)


def register_function(spark: SparkSession, name: str, fn: Callable, return_type: str):
    """Make a Python function callable by name in SQL."""
    return spark.udf.register(name, row_udf(fn, return_type))
