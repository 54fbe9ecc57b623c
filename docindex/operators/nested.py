"""The ``nested`` query over documents whose nested objects are kept as a
child table (one row per nested object, with the parent key).

An index keeps nested objects inside the parent document; in a table store
they are usually a separate table.  ``where_nested`` gives the same result
as ``where_query(parent_with_array, {"nested": ...})`` without building
arrays: the inner query filters the children, their distinct parent keys
(pre-aggregated before the shuffle, so a parent with very many children
costs one key per map task) semi-join the parents.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.functions.query import QueryCompiler, to_query_dict


def nested_condition(children: DataFrame, path: str, query: Any):
    """The inner query as a condition on child rows (fields as ``path.x``)."""
    qc = QueryCompiler(children.schema)
    qc._scopes.append((path, None, children.schema))
    return qc.compile(to_query_dict(query))


def where_nested(parent: DataFrame, children: DataFrame, parent_key: str, child_key: str,
                 path: str, query: Any) -> DataFrame:
    matched = (children.where(nested_condition(children, path, query))
               .select(F.col(child_key).alias(parent_key)).distinct())
    return parent.join(matched, parent_key, "left_semi")
