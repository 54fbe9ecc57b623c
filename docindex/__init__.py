"""docindex: search-index documents as Spark DataFrames.

Read, query, transform and write collections of JSON-like documents held in
a search index or in plain files.  Queries in the common search-query JSON
form compile to Catalyst expressions; bulk index/create/update/delete
actions apply as relational upserts; relevance is a DataFrame job.
"""

import sys as _sys

try:
    from pyspark import cloudpickle as _cloudpickle
except ImportError:  # a client without it ships functions its own way
    _cloudpickle = None
if _cloudpickle is not None:
    # functions of this package go to Python workers by value; what they
    # broadcast are arrays, numbers and texts, never objects of the package
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from docindex.functions.analyzer import analyze, tokens
from docindex.functions.query import Q, count_query, query_column, where_query
from docindex.functions.values import conform, parse_date, parse_timestamp
from docindex.operators.bulk import action_lines, apply_bulk, bulk_actions
from docindex.operators.chunks import chunks
from docindex.operators.nested import where_nested
from docindex.operators.score import bm25, search, search_nested
from docindex.operators.transform import (
    map_document_batches, map_documents, unwrap_document, unwrap_documents,
)
from docindex.sources.datasource import (
    DocIndexDataSource, count_remote, read_remote, register, size_remote, write_remote,
)
from docindex.sources.hits import as_hits, flatten_hits, nest_hits, read_slice, slice_column
from docindex.sources.json_hits import hits_from_json, hits_to_json, read_hits_json, write_hits_json
from docindex.sources.mapping import mapping_to_struct
from docindex.sources.merge import merge_mappings, merge_schemas, union_indices
from docindex.sources.model import Document, InnerDoc, Nested, Object, model_to_struct
from docindex.sources.paging import pages, rows_after
from docindex.sources.schema import META_FIELDS, complete_schema
from docindex.sources.slices import drop_slices, read_slices, write_slices
from docindex.sources.stats import column_bounds, size_estimate
from docindex.sources.store import read_index, versions, write_bulk, write_index

__all__ = [
    "analyze", "tokens",
    "Q", "count_query", "query_column", "where_query",
    "conform", "parse_date", "parse_timestamp",
    "action_lines", "apply_bulk", "bulk_actions", "chunks", "where_nested", "bm25", "search", "search_nested",
    "map_document_batches", "map_documents", "unwrap_document", "unwrap_documents",
    "DocIndexDataSource", "count_remote", "read_remote", "register", "size_remote", "write_remote",
    "as_hits", "flatten_hits", "nest_hits", "read_slice", "slice_column",
    "hits_from_json", "hits_to_json", "read_hits_json", "write_hits_json", "mapping_to_struct",
    "merge_mappings", "merge_schemas", "union_indices", "pages", "rows_after", "drop_slices", "read_slices", "write_slices", "column_bounds",
    "Document", "InnerDoc", "Nested", "Object", "model_to_struct",
    "META_FIELDS", "complete_schema", "size_estimate",
    "read_index", "versions", "write_bulk", "write_index",
]
