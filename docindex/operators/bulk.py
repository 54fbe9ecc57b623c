"""Bulk actions (index, create, update, delete) as relational operations.

``bulk_actions`` shapes rows into actions the way a bulk sink does: columns
starting with ``_`` are metadata, the rest is the document; sink arguments
override per-row ``_index`` / ``_op_type``.

``apply_bulk`` applies an action table to an index held as a DataFrame:

* one aggregation per document key folds all of its actions (the last
  index/create/delete wins; later updates win column by column).  The
  aggregation is partial: a key with very many actions is pre-combined on
  the map side before the shuffle, so a hot key costs one row per map task;
* a left join of the index with the folded actions (the folded actions are
  the build side: small batches are broadcast at run time by AQE and the
  index is not shuffled), plus the new keys found from the index's key
  column only;
* validation (``create`` on an existing document, ``update`` or ``delete``
  on a missing one) fails the job with the offending id, as the bulk helper
  fails on the first error.  Validation needs each action's predecessor; it
  runs in buckets of consecutive order values so that a hot key is split
  over many tasks (the first action of a key is checked from the aggregate).

Column semantics of ``update``: a column present in the action table is set,
also to null; a column absent from it is kept.  Object (struct) columns merge
field by field, recursively; arrays and scalars are replaced.  An optional ``_fields``
array<string> column narrows an update row to the named columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from docindex.session import scratch_path, shared_dir
from docindex.sources.schema import meta_name

# The four bulk operations.
OP_TYPES = ("index", "create", "update", "delete")


def _src_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def bulk_actions(df: DataFrame, index: str | None = None, op_type: str | None = None,
                 source_fields: Iterable[str] | None = None,
                 meta_fields: Iterable[str] | None = None,
                 order_col: str | None = None) -> DataFrame:
    """Rows to action rows: ``_op_type, _index, _id, ...meta, source columns``.

    ``meta_fields`` names (without ``_``) select the metadata columns used;
    ``source_fields`` select document fields.  A missing op is ``index``.
    ``order_col`` is kept whatever the field lists say.
    """
    if op_type is not None and op_type not in OP_TYPES:
        raise ValueError(f"op_type must be one of {OP_TYPES}, got {op_type!r}")
    metas = [c for c in df.columns if c.startswith("_")]
    if meta_fields is not None:
        wanted = {meta_name(m) for m in meta_fields}
        metas = [c for c in metas if c in wanted]
    src = _src_cols(df)
    if source_fields is not None:
        keep = set(source_fields)
        src = [c for c in src if c in keep]
    op = F.lit(op_type) if op_type else (F.col("_op_type") if "_op_type" in metas else F.lit(None))
    idx = F.lit(index) if index else (F.col("_index") if "_index" in metas else F.lit(None))
    cols = [
        F.lower(F.coalesce(op.cast("string"), F.lit("index"))).alias("_op_type"),
        *([idx.cast("string").alias("_index")] if (index or "_index" in metas) else []),
        (F.col("_id").cast("string") if "_id" in metas else F.lit(None).cast("string")).alias("_id"),
    ]
    cols += [F.col(m) for m in metas if m not in ("_op_type", "_index", "_id")]
    cols += [F.col("`" + c + "`") for c in src]
    if order_col and order_col not in metas and order_col not in src:
        cols.append(F.col("`" + order_col + "`"))
    out = df.select(*cols)
    bad = ~F.col("_op_type").isin(*OP_TYPES)
    return out.withColumn("_op_type", F.when(bad, F.raise_error(
        F.concat(F.lit("unknown op_type: "), F.col("_op_type")))).otherwise(F.col("_op_type")))


def action_lines(actions: DataFrame) -> DataFrame:
    """The bulk wire form: one header line and, except for delete, one body.

    ``header`` is ``{"<op>":{"_index":..,"_id":..}}``; ``body`` is the
    document (index, create) or ``{"doc": document}`` (update).  Null fields
    are written as null.
    """
    src = _src_cols(actions)
    if "_index" not in actions.columns:
        actions = actions.withColumn("_index", F.lit(None).cast("string"))
    meta = F.struct(F.col("_index"), F.col("_id"))
    op = F.col("_op_type")
    header = F.when(op == "index", F.to_json(F.struct(meta.alias("index"))))
    for name in OP_TYPES[1:]:
        header = header.when(op == name, F.to_json(F.struct(meta.alias(name))))
    doc = F.struct(*[F.col("`" + c + "`") for c in src])
    opts = {"ignoreNullFields": "false"}
    body = (F.when(op.isin("index", "create"), F.to_json(doc, opts))
            .when(op == "update", F.to_json(F.struct(doc.alias("doc")), opts)))
    return actions.select("_op_type", "_index", "_id", header.alias("header"), body.alias("body"))


def _auto_id(run: str, row: Column) -> Column:
    """An id of its own for every action: the bulk run and the stored input
    position, so equal actions stay two documents."""
    return F.concat(F.lit(run + "-"), F.lpad(F.hex(row), 16, "0"))


def _union_struct(ct: StructType, at: StructType) -> StructType:
    """Fields of the index's object type, then fields only the actions have."""
    afields = {f.name: f for f in at.fields}
    out = []
    for f in ct.fields:
        a = afields.get(f.name)
        if a is not None and isinstance(f.dataType, StructType) and isinstance(a.dataType, StructType):
            out.append(StructField(f.name, _union_struct(f.dataType, a.dataType), True))
        else:
            out.append(StructField(f.name, f.dataType, True))
    names = {f.name for f in ct.fields}
    out += [StructField(a.name, a.dataType, True) for a in at.fields if a.name not in names]
    return StructType(out)


def _shape(c: Column, t: DataType, u: DataType) -> Column:
    """``c`` of type ``t`` as type ``u`` (missing object fields null)."""
    if isinstance(t, StructType) and isinstance(u, StructType):
        have = {f.name: f.dataType for f in t.fields}
        parts = [(_shape(c.getField(f.name), have[f.name], f.dataType) if f.name in have
                  else F.lit(None).cast(f.dataType)).alias(f.name) for f in u.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    return c if t == u else c.cast(u)


def _merge(upd: Column, at: StructType, found: Column, u: StructType) -> Column:
    """A partial update of an object: fields it names are set (recursively
    for objects, also to null), the others keep the value found."""
    have = {f.name: f.dataType for f in at.fields}
    parts = []
    for f in u.fields:
        if f.name not in have:
            v = found.getField(f.name)
        elif isinstance(have[f.name], StructType) and isinstance(f.dataType, StructType):
            v = _merge(upd.getField(f.name), have[f.name], found.getField(f.name), f.dataType)
        else:
            v = _shape(upd.getField(f.name), have[f.name], f.dataType)
        parts.append(v.alias(f.name))
    return F.when(upd.isNotNull(), F.struct(*parts))


def _bad(prev: Column, op: Column) -> Column:
    """An action that may not follow ``prev`` on the same document."""
    return (((prev == "delete") & op.isin("update", "delete"))
            | (prev.isin("index", "create", "update") & (op == "create")))


def _bad_pairs(A: DataFrame, key: list[str], width: int) -> DataFrame:
    """Per key, the op of the first action that may not follow its predecessor.

    Neighbours are compared in three levels, so that a key with very many
    actions is spread over many tasks: inside runs of rows with one order value
    (``width`` row numbers at most), then between these runs inside ranges of
    order values, then between the ranges.  Each level hands one row a group
    (its first and last op) to the next.
    """
    rows = A.select(*key, F.col("_op").alias("_first"), F.col("_op").alias("_last"), F.struct("_v", "_r").alias("_at"),
                    "_v", "_r", F.expr(f"_v div {int(width)}").alias("_vb"), F.expr(f"_r div {int(width)}").alias("_rb"))
    found = None
    for group, order in ((["_vb", "_v", "_rb"], ["_r"]), (["_vb"], ["_v", "_rb"]), ([], ["_vb"])):
        w = Window.partitionBy(*key, *group).orderBy(*order)
        bad = (rows.withColumn("_prev", F.lag("_last").over(w)).where(_bad(F.col("_prev"), F.col("_first")))
               .select(*key, F.col("_first").alias("_pair_op"), "_at"))
        found = bad if found is None else found.unionByName(bad)
        if group:
            at = F.struct(*order)
            rows = rows.groupBy(*key, *group).agg(F.min_by("_first", at).alias("_first"), F.max_by("_last", at).alias("_last"), F.min("_at").alias("_at"))
    return found.groupBy(*key).agg(F.min_by("_pair_op", "_at").alias("_pair_op"))


def apply_bulk(current: DataFrame, actions: DataFrame, order_col: str | None = None,
               validate: bool = True, bucket_width: int = 1 << 20,
               materialize: bool = True) -> DataFrame:
    """The index after applying ``actions`` (as from ``bulk_actions``).

    ``current`` is a flat index (``_id`` plus document columns, optionally
    ``_index``, ``_version``, ``_seq_no``, ``_primary_term``).  ``order_col``
    orders actions on the same document (non-negative integers); without it,
    and among equal values, the input order (task, then row) is used.  Actions
    come from many tasks: where two actions of a document may tie, give
    ``order_col`` values that tell them apart, or the result follows the rows'
    places in the input.  The result has the union of the document columns of
    both tables.
    """
    if "_op_type" not in actions.columns:
        actions = bulk_actions(actions)
    keyed = "_index" in actions.columns and "_index" in current.columns
    key = ["_index", "_id"] if keyed else ["_id"]

    run = uuid.uuid4().hex
    a_src = _src_cols(actions)
    c_src = _src_cols(current)
    narrowed = "_fields" in actions.columns
    # the input position, numbered once: the fold, its checks and automatic
    # ids all read the same stored rows
    actions = actions.withColumn("_row", F.monotonically_increasing_id())
    if materialize:
        path = scratch_path(actions.sparkSession, "actions")
        actions.write.parquet(path)
        actions = actions.sparkSession.read.schema(actions.schema).parquet(path)
    order = F.col("`" + order_col + "`") if order_col else F.col("_row")
    A = actions.select(
        *[F.col(k) for k in key if k != "_id"],
        F.col("_op_type").alias("_op"),
        order.cast("long").alias("_v"),
        F.col("_row").alias("_r"),
        F.col("_id"),
        *([F.col("_fields")] if narrowed else []),
        *[F.col("`" + c + "`") for c in a_src],
    )
    A = A.withColumn("_id", F.when(F.col("_id").isNull() & F.col("_op").isin("index", "create"),
                                   _auto_id(run, F.col("_r"))).otherwise(F.col("_id")))
    A = A.withColumn("_id", F.when(F.col("_id").isNull(), F.raise_error(
        F.concat(F.lit("action without _id: "), F.col("_op")))).otherwise(F.col("_id")))

    # a total order: the order value, then the stored row
    op, o = F.col("_op"), F.struct("_v", "_r")
    row = F.struct(F.lit(True).alias("_some"), *[F.col("`" + c + "`") for c in a_src])
    reset_o, upd_o = F.when(op != "update", o), F.when(op == "update", o)
    # the last reset and the last update as whole rows, one aggregate each
    aggs = [
        F.max(reset_o).alias("_reset_o"),
        F.max_by(F.struct(op.alias("_op"), row.alias("_row")), reset_o).alias("_reset"),
        F.min_by(op, o).alias("_first_op"),
        F.count(F.lit(1)).alias("_n"),
        F.max("_v").alias("_last_o"),
    ]
    if narrowed:
        # updates that name fields: the last one is found field by field
        for c in a_src:
            own = F.when((op == "update") & (F.col("_fields").isNull() | F.array_contains(F.col("_fields"), c)), o)
            aggs += [F.max_by(F.struct(F.col("`" + c + "`").alias("_x")), own).alias("_u_" + c), F.max(own).alias("_uo_" + c)]
    else:
        aggs += [F.max_by(row, upd_o).alias("_update"), F.max(upd_o).alias("_update_o")]
    G = A.groupBy(*key).agg(*aggs)
    G = G.withColumn("_reset_op", F.col("_reset._op"))

    if validate:
        G = G.join(_bad_pairs(A, key, bucket_width), key, "left")
    else:
        G = G.withColumn("_pair_op", F.lit(None).cast("string"))

    cur_meta = [m for m in ("_version", "_seq_no", "_primary_term") if m in current.columns]
    carry = ["_index"] if ("_index" in current.columns and "_index" not in key) else []
    C = current.select(*[F.col(k) for k in key], *[F.col(m) for m in carry + cur_meta],
                       *[F.col("`" + c + "`").alias("_c_" + c) for c in c_src],
                       F.lit(True).alias("_existed"))
    # Which action keys exist: the index's key column semi-joined with the
    # action keys (the folded side is the build side; AQE broadcasts it at
    # run time when it is small, so the index is not shuffled).
    touched = current.select(*key).join(G.select(*key), key, "left_semi") \
        .withColumn("_existed", F.lit(True))
    Gx = G.join(touched, key, "left")
    existed = F.coalesce(F.col("_existed"), F.lit(False))
    first = F.col("_first_op")
    err = (F.when((first == "create") & existed,
                  F.concat(F.lit("create: document already exists: "), F.col("_id")))
           .when(first.isin("update", "delete") & ~existed,
                 F.concat(first, F.lit(": document missing: "), F.col("_id")))
           .when(F.col("_pair_op") == "create",
                 F.concat(F.lit("create: document already exists: "), F.col("_id")))
           .when(F.col("_pair_op").isNotNull(),
                 F.concat(F.col("_pair_op"), F.lit(": document missing: "), F.col("_id"))))
    # The check reads the right side of the left join, so Catalyst keeps it
    # above that join: it sees every folded key exactly once.
    Gv = Gx.where(F.when(err.isNotNull(), F.raise_error(err)).otherwise(F.lit(True)))
    if materialize:
        # One row per touched key, used three times below: computed once
        # and written to the shared checkpoint folder (survives executor
        # loss; cuts the actions' lineage).
        shared_dir(current.sparkSession)
        Gv = Gv.checkpoint(eager=True)
    # Existing documents: the index left-joined with the folded actions
    # (the folded side is the build side again).  New documents: folded
    # keys that did not exist.
    old = C.join(Gv.drop("_existed"), key, "left")
    new = Gv.where(~existed).withColumn("_existed", F.lit(False))
    J = old.unionByName(new, allowMissingColumns=True)

    existed = F.coalesce(F.col("_existed"), F.lit(False))
    has_actions = F.col("_n").isNotNull()
    has_reset = F.col("_reset_o").isNotNull()
    exists_after = F.when(~has_actions, existed).when(has_reset, F.col("_reset_op") != "delete") \
        .otherwise(existed)
    keep = exists_after

    out_cols = []
    for c in list(dict.fromkeys(c_src + a_src)):
        ctype = current.schema[c].dataType if c in c_src else None
        atype = actions.schema[c].dataType if c in a_src else None
        both = isinstance(ctype, StructType) and isinstance(atype, StructType)
        utype = _union_struct(ctype, atype) if both else None
        base = F.col("_c_" + c) if c in c_src else F.lit(None)
        if both:
            base = _shape(base, ctype, utype)
        if c in a_src:
            reset_val = F.col(f"_reset._row.`{c}`")
            upd_val = F.col(f"_u_{c}._x") if narrowed else F.col(f"_update.`{c}`")
            upd_at = F.col("_uo_" + c) if narrowed else F.col("_update_o")
            if both:
                reset_val, upd_val = _shape(reset_val, atype, utype), upd_val
            from_reset = F.when(F.col("_reset_op").isin("index", "create"), reset_val)
            updated = upd_at.isNotNull() & (~has_reset | (upd_at > F.col("_reset_o")))
            if both:
                # objects merge field by field into what the update finds
                found = F.when(has_reset, from_reset).otherwise(base)
                upd_val = _merge(upd_val, atype, found, utype)
            val = (F.when(~has_actions, base)
                   .when(updated, upd_val)
                   .when(has_reset, from_reset)
                   .otherwise(base))
        else:
            val = F.when(has_actions & has_reset, F.lit(None)).otherwise(base)
        out_cols.append(val.alias(c))

    old_version = F.col("_version") if "_version" in cur_meta else F.when(existed, F.lit(1))
    version = (F.coalesce(old_version, F.lit(0)) + F.coalesce(F.col("_n"), F.lit(0))).cast("long")
    if "_seq_no" in cur_meta:
        # old maximum as a scalar subquery: one partial aggregate, no driver job
        seq_base = current.agg(F.coalesce(F.max("_seq_no"), F.lit(-1)).cast("long")).scalar()
        seq = F.when(has_actions, seq_base + F.lit(1) + F.col("_last_o")).otherwise(F.col("_seq_no"))
    else:
        seq = F.when(has_actions, F.col("_last_o"))
    term = F.col("_primary_term") if "_primary_term" in cur_meta else F.lit(1)
    return J.where(keep).select(
        *[F.col(k) for k in carry + key],
        version.alias("_version"),
        seq.cast("long").alias("_seq_no"),
        F.coalesce(term, F.lit(1)).cast("long").alias("_primary_term"),
        *out_cols,
    )


__all__ = ["OP_TYPES", "bulk_actions", "action_lines", "apply_bulk"]
