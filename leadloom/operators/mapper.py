"""A user's function over rows in parallel, with errors kept per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

#: Rows that are Python objects at a time.
PIECE_ROWS = 1024


def map_rows(df: DataFrame, fn: Callable[[dict[str, Any]], object], column: str, kind: str = "string") -> DataFrame:
    """Adds column with fn(row) and error with the message where fn failed; a row is a dict of plain values, null is None.

    Parallelism is the number of partitions.
    """
    arrow = to_arrow_type(_parse_datatype_string(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PIECE_ROWS):
                b, values, errors = whole.slice(at, PIECE_ROWS), [], []
                for row in b.to_pylist():
                    try:
                        values.append(fn(row))
                        errors.append(None)
                    except Exception as e:  # kept for the caller, row by row
                        values.append(None)
                        errors.append(f"{type(e).__name__}: {e}")
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values, arrow), pa.array(errors, pa.string())], names=[*b.schema.names, column, "error"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{own}, `{column}` {kind}, error string")
