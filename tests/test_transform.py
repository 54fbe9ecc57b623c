"""Document transforms (row and batch), nested and flat rows."""

import pandas as pd

from docindex.operators.transform import (
    map_document_batches, map_documents, unwrap_document, unwrap_documents,
)
from docindex.sources.model import Document, Text


class _Doc(Document):
    field = Text(required=True)


def test_unwrap_document_nested_and_flat():
    @unwrap_document(_Doc)
    def add(row, doc):
        return {**row, "custom": doc.field}

    nested = {"_index": "i", "_id": "1", "_source": {"field": "example"}}
    assert add(nested) == {**nested, "custom": "example"}
    flat = {"_index": "i", "_id": "1", "field": "example"}
    assert add(flat)["custom"] == "example"


def test_unwrap_documents_batch():
    @unwrap_documents(_Doc)
    def add(batch, docs):
        batch = batch.copy()
        batch["custom"] = [d.field for d in docs]
        return batch

    data = pd.DataFrame([{"_id": str(i), "_source": {"field": f"example{i}"}} for i in range(5)])
    out = add(data)
    assert list(out["custom"]) == [f"example{i}" for i in range(5)]
    flat = pd.DataFrame([{"_id": str(i), "field": f"example{i}"} for i in range(5)])
    assert list(add(flat)["custom"]) == [f"example{i}" for i in range(5)]


def test_map_documents_on_spark(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "bb")], "_id string, field string")
    out = map_documents(df, _Doc, lambda r, d: {"_id": r["_id"], "n": len(d.field)}, "_id string, n long")
    assert sorted(tuple(r) for r in out.collect()) == [("1", 1), ("2", 2)]

    def batch(b, docs):
        b = b.copy()
        b["up"] = [d.field.upper() for d in docs]
        return b

    out = map_document_batches(df, _Doc, batch, "_id string, field string, up string")
    assert sorted(r.up for r in out.collect()) == ["A", "BB"]


def test_large_integers_and_nulls_survive(spark):
    class Big(Document):
        name = Text(required=False)
    df = spark.createDataFrame([("1", 9007199254740993), ("2", None)], "_id string, n long")
    seen = map_documents(df, Big, lambda row, doc: {**row, "n": None if row["n"] is None else row["n"] + 1}, "_id string, n long")
    assert {r._id: r.n for r in seen.collect()} == {"1": 9007199254740994, "2": None}
    same = map_document_batches(df, Big, lambda frame, docs: frame, "_id string, n long")
    assert {r._id: r.n for r in same.collect()} == {"1": 9007199254740993, "2": None}
