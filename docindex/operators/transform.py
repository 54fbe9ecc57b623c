"""Document-typed transforms over DataFrames.

A row (metadata columns starting with ``_`` plus source fields, or a nested
hit) is decoded into a declared document object and handed to user code
together with the row.  Rows travel as Arrow batches and become Python values
by Arrow's own types: integers stay integers, nulls stay null.  Prefer plain
columns where the transform is expressible without the document object.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docindex.sources.schema import as_struct

#: pandas types that keep whole numbers and truth values beside nulls.
_NULLABLE = {
    pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(),
    pa.int64(): pd.Int64Dtype(), pa.bool_(): pd.BooleanDtype(),
}


def _records(batch: Any) -> list[dict]:
    """The rows of an Arrow batch or table, a pandas frame or a column dict."""
    if isinstance(batch, pd.DataFrame):
        batch = pa.Table.from_pandas(batch, preserve_index=False)
    elif isinstance(batch, Mapping):
        batch = pa.table(dict(batch))
    return batch.to_pylist(maps_as_pydicts="strict")


def unwrap_document(model: type) -> Callable:
    """Decorator for ``fn(row, document)``: callers pass the row only."""
    def wrap(fn: Callable[[dict, Any], dict]) -> Callable[[dict], dict]:
        return functools.wraps(fn)(lambda row: fn(row, model.from_hit(row)))
    return wrap


def unwrap_documents(model: type) -> Callable:
    """Decorator for ``fn(batch, documents)``: callers pass the batch only."""
    def wrap(fn: Callable[[Any, Sequence], Any]) -> Callable[[Any], Any]:
        return functools.wraps(fn)(lambda batch: fn(batch, [model.from_hit(r) for r in _records(batch)]))
    return wrap


def map_documents(df: DataFrame, model: type, fn: Callable[[dict, Any], dict],
                  schema: StructType | str) -> DataFrame:
    """Apply ``fn(row, document) -> row`` to every row; ``schema`` is the output."""
    out = as_struct(schema)
    types = to_arrow_schema(out)
    run = unwrap_document(model)(fn)

    def batches(it):
        for batch in it:
            yield pa.RecordBatch.from_pylist([run(r) for r in _records(batch)], schema=types)

    return df.mapInArrow(batches, out)


def map_document_batches(df: DataFrame, model: type, fn: Callable[[pd.DataFrame, Sequence], pd.DataFrame],
                         schema: StructType | str) -> DataFrame:
    """Apply ``fn(frame, documents) -> frame`` to each batch, a pandas frame
    with nullable integer and boolean columns."""
    out = as_struct(schema)
    types = to_arrow_schema(out)

    def batches(it):
        for batch in it:
            docs = [model.from_hit(r) for r in _records(batch)]
            frame = fn(batch.to_pandas(types_mapper=_NULLABLE.get), docs)
            table = pa.Table.from_pandas(frame[out.fieldNames()], schema=types, preserve_index=False)
            yield from table.to_batches()

    return df.mapInArrow(batches, out)
