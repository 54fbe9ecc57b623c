"""Relevance: BM25 as a DataFrame job, for one field and for whole queries.

score(d) = sum over query terms t of
    idf(t) * tf(t, d) / (tf(t, d) + k1 * (1 - b + b * dl(d) / avgdl))
    idf(t) = ln(1 + (N - df(t) + 0.5) / (df(t) + 0.5))

(the form used by current Lucene versions; k1 = 1.2, b = 0.75 by default;
document lengths are exact token counts, not Lucene's one-byte norms).

* A phrase is a term of its own: its frequency is how often its tokens stand
  next to each other, its idf the sum of its tokens' idfs.
* A keyword has no length: idf / (1 + k1), for ``term`` in both spellings and for
  ``match``.  Numbers, dates and booleans score 1.
* ``nested``: every nested object is a document of its own (N, df, avgdl count
  objects); the scores of the matching ones are joined by ``score_mode``.
* ``cross_fields``: a term has one document frequency over all fields, the
  highest one (a little more in a field where it is rarer), and the best field
  counts.

Plan: each text is marked once per pass (see ``functions.analyzer``), in a
generator that no projection is merged into.  The statistics of the whole query
are one partial aggregate over the marked texts, one small row back; the scores
are a projection of the matching documents.  No shuffle of document rows, and
nothing is stored between the two passes unless ``checkpoint`` asks for it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from docindex.functions import analyzer as A
from docindex.functions.fields import View
from docindex.functions.query import QueryCompiler, marked_texts, query_column, to_query_dict, where_query
from docindex.session import shared_dir

# The default BM25 parameters.
K1 = 1.2
B = 0.75


def idf(n: float, dfreq: float) -> float:
    return math.log(1 + (n - dfreq + 0.5) / (dfreq + 0.5))


def _quoted(name: str) -> Column:
    return F.col("`" + name + "`")


class _Statistics:
    """Named figures of the corpus, asked for first and read later."""

    def __init__(self):
        self.asked: dict[tuple, Column] = {}
        self.row = None

    def of(self, key: tuple, figure: Callable[[], Column]) -> float:
        if self.row is None:
            if key not in self.asked:
                self.asked[key] = figure()
            return 1.0
        return float(self.row[list(self.asked).index(key)] or 0.0)

    def read(self, df: DataFrame) -> None:
        """One partial aggregate over the whole index; one small row back."""
        aggs = [c.alias(f"s{i}") for i, c in enumerate(self.asked.values())]
        self.row = df.agg(*aggs).first() if aggs else ()


class _Scorer:
    """The score column of a query.  Built twice: once to learn which figures
    and marked texts it needs, once with them."""

    def __init__(self, schema: StructType, k1: float, b: float):
        self.schema, self.k1, self.b = schema, k1, b
        self.stats = _Statistics()
        self.qc = QueryCompiler(schema)
        # (path, array column) of the nested objects that are scored just now
        self.nested: list[tuple[str, Column]] = []
        #: of each nested path the text passes asked for, and the prepared array
        #: (``e``: the object, ``m0``...: its marked texts, in the order of keys)
        self.nested_touched: dict[str, dict] = {}
        self.prepared: dict[str, tuple[Column, list[tuple[str, str]]]] = {}

    # -- figures of the corpus, or of all nested objects of a path ----------
    def _over(self, cond: Callable[[], Column]) -> Column:
        """How many documents (nested objects) satisfy ``cond``."""
        if not self.nested:
            return F.count_if(cond())
        return F.sum(F.size(F.filter(self.nested[-1][1], lambda x: self._inside(x, lambda: F.coalesce(cond(), F.lit(False))))))

    def _total(self, value: Callable[[], Column]) -> Column:
        if not self.nested:
            return F.sum(value())
        each = F.transform(self.nested[-1][1], lambda x: self._inside(x, lambda: F.coalesce(value(), F.lit(0)).cast("double")))
        return F.sum(F.aggregate(each, F.lit(0.0), lambda a, v: a + v))

    def _inside(self, x: Column, build: Callable[[], Column]) -> Column:
        path, _ = self.nested[-1]
        touched, marks = self.nested_touched.setdefault(path, {}), {}
        if path in self.prepared:
            marks = {key: A.Marked(x.getField(f"m{i}")) for i, key in enumerate(self.prepared[path][1])}
            x = x.getField("e")
        self.qc._scopes.append((path, x, self._element(path), (marks, touched)))
        try:
            return build()
        finally:
            self.qc._scopes.pop()

    def _element(self, path: str) -> StructType:
        dt = self.schema
        for part in path.split("."):
            dt = dt[part].dataType
            while isinstance(dt, ArrayType):
                dt = dt.elementType
        return dt

    def _on(self, path: str, use: Callable[[View], Column]) -> Column:
        """``use`` of the field as it is seen at this place of the query."""
        return self.qc.field_pred(path, use)

    # -- leaves ----------------------------------------------------------------
    def _view(self, path: str) -> View | None:
        if not self.nested:
            return self.qc.view(path)
        got: list[View] = []
        F.filter(self.nested[-1][1], lambda x: self._inside(x, lambda: got.append(self.qc.view(path)) or F.lit(True)))
        return got[0] if got else None

    def _key(self, *parts) -> tuple:
        return (self.nested[-1][0] if self.nested else None, *parts)

    def _counts(self, path: str) -> tuple[float, float]:
        """Documents that have the text, and their mean length."""
        n = self.stats.of(self._key("n", path), lambda: self._over(lambda: self._on(path, lambda v: v.marked().tokens.isNotNull())))
        length = self.stats.of(self._key("dl", path), lambda: self._total(lambda: self._on(path, lambda v: v.marked().length())))
        return n, (length / n if n else 0.0) or 1.0

    def _frequency(self, path: str, tok: str) -> float:
        return self.stats.of(self._key("df", path, tok), lambda: self._over(lambda: self._on(path, lambda v: v.marked().has(tok))))

    def _text_score(self, path: str, weight: float, toks: list[str]) -> Column:
        """``weight`` (an idf) times the length-normed frequency of ``toks``."""
        _, avgdl = self._counts(path)

        def use(v: View) -> Column:
            m = v.marked(line=len(toks) > 1)
            tf = m.count(toks).cast("double")
            norm = F.lit(self.k1) * (F.lit(1 - self.b) + F.lit(self.b) * m.length() / F.lit(avgdl))
            return F.coalesce(F.lit(weight) * tf / (tf + norm), F.lit(0.0))
        return self._on(path, use)

    def _terms(self, path: str, toks: list[str]) -> Column:
        n, _ = self._counts(path)
        return _sum([self._text_score(path, times * idf(n, self._frequency(path, t)), [t]) for t, times in sorted(Counter(toks).items())])

    def _phrase(self, path: str, toks: list[str]) -> Column:
        n, _ = self._counts(path)
        return self._text_score(path, sum(idf(n, self._frequency(path, t)) for t in toks), toks)

    def _keyword(self, path: str, query: dict) -> Column:
        """A keyword has no length: every match scores the same."""
        n = self.stats.of(self._key("n", path), lambda: self._over(lambda: self.qc.compile({"exists": {"field": path}})))
        dfreq = self.stats.of(self._key("dv", path, repr(query)), lambda: self._over(lambda: self.qc.compile(query)))
        return F.lit(idf(n, dfreq) / (1 + self.k1))

    # -- queries -----------------------------------------------------------------
    def score(self, q: dict, root: bool = False) -> Column:
        """Score of a query, 0 where it doesn't match."""
        (name, p), = q.items()
        boost = 1.0
        if isinstance(p, dict) and name != "constant_score":
            spec = next(iter(p.values())) if len(p) == 1 and "boost" not in p else p
            boost = float(spec.get("boost", 1.0)) if isinstance(spec, dict) else 1.0
        out, zero = self._score(name, p)
        if boost != 1.0:
            out = out * F.lit(boost)
        if root or zero:  # only matches come here, or the others score 0 by themselves
            return out
        return F.when(F.coalesce(self.qc.compile(q), F.lit(False)), out).otherwise(F.lit(0.0))

    def _score(self, name: str, p) -> tuple[Column, bool]:
        """(score, whether it is 0 where the query doesn't match)."""
        if name == "bool":
            clauses = [c for k in ("must", "should") for c in _listed(p.get(k))]
            return _sum([self.score(c) for c in clauses]), not any(p.get(k) for k in ("must", "filter", "must_not", "minimum_should_match"))
        if name in ("match", "match_phrase", "match_phrase_prefix"):
            (field, spec), = p.items()
            spec = spec if isinstance(spec, dict) else {"query": spec}
            return self._full_text(name, self.qc.aliases.get(field, field), spec)
        if name == "multi_match":
            return self._multi_match(p)
        if name == "dis_max":
            return _dis_max([self.score(c) for c in p.get("queries", [])], float(p.get("tie_breaker", 0.0))), True
        if name == "boosting":
            less = F.when(F.coalesce(self.qc.compile(p["negative"]), F.lit(False)), F.lit(float(p.get("negative_boost", 1.0)))).otherwise(1.0)
            return self.score(p["positive"]) * less, True
        if name == "constant_score":
            return F.lit(float(p.get("boost", 1.0))), False
        if name == "term":
            (field, spec), = p.items()
            field = self.qc.aliases.get(field, field)
            value = spec.get("value") if isinstance(spec, dict) else spec
            v = self._view(field)
            if v is not None and v.is_text(full_text=False):
                return self._terms(field, [str(value)]), True
            if v is not None and isinstance(v.dtype, StringType):
                plain = {"value": value} | ({"case_insensitive": True} if isinstance(spec, dict) and spec.get("case_insensitive") else {})
                # matched without regard to case, a term is one of many: a constant
                return (F.lit(1.0) if "case_insensitive" in plain else self._keyword(field, {"term": {field: plain}})), False
            return F.lit(1.0), False
        if name == "nested":
            return self._nested(p), False
        # range, exists, prefix, wildcard, regexp, ids, terms, match_all: constant
        return F.lit(1.0), False

    def _full_text(self, name: str, field: str, spec: dict) -> tuple[Column, bool]:
        v = self._view(field)
        if v is None:
            return F.lit(1.0), False
        if v.is_text(full_text=True):
            toks = A.analyze(spec["query"], v.analyzer)
            if not toks:
                return F.lit(0.0), True
            if name == "match_phrase_prefix":
                return F.lit(1.0), False  # many phrases at once: a constant
            if name == "match_phrase" and len(toks) > 1:
                return self._phrase(field, toks), True
            return self._terms(field, toks), str(spec.get("operator", "or")).lower() == "or" and spec.get("minimum_should_match") is None
        if isinstance(v.dtype, StringType):
            return self._keyword(field, {"term": {field: {"value": spec["query"]}}}), False
        return F.lit(1.0), False

    def _multi_match(self, p: dict) -> tuple[Column, bool]:
        listed = p.get("fields")
        weighted = [(f, float((x.split("^", 1) + ["1"])[1])) for x in listed or ["*"] for f in self.qc.resolve_fields([x])]
        if not listed:  # all text fields
            weighted = [(f, w) for f, w in weighted if (v := self._view(f)) is not None and v.is_text(full_text=True)]
        kind, tie = p.get("type", "best_fields"), float(p.get("tie_breaker", 0.0))
        if kind == "cross_fields":
            return self._cross_fields(p["query"], weighted, tie), False
        leaf = {"phrase": "match_phrase", "phrase_prefix": "match_phrase_prefix"}.get(kind, "match")
        more = {k: p[k] for k in ("operator", "minimum_should_match") if k in p and leaf == "match"}
        subs = [self.score({leaf: {f: {"query": p["query"], "boost": w, **more}}}) for f, w in weighted]
        return (_sum(subs) if kind == "most_fields" else _dis_max(subs, tie)), True

    def _cross_fields(self, text: str, weighted: list[tuple[str, float]], tie: float) -> Column:
        """Per term, the best field under a document frequency that all fields
        share; text fields only, others score as keywords."""
        texts = [(f, w) for f, w in weighted if (v := self._view(f)) is not None and v.is_text(full_text=True)]
        others = [(f, w) for f, w in weighted if (f, w) not in texts]
        terms = []
        for t in sorted(set(A.analyze(text))):
            found = {f: self._frequency(f, t) for f, _ in texts}
            every = {f: self._counts(f)[0] for f, _ in texts}
            blended, high, steps = {}, max(found.values(), default=0.0), 0
            before = high
            for f in sorted(found, key=lambda f: -found[f]):
                steps += found[f] < before
                before = found[f]
                blended[f] = min(max(every.values()), high + steps)
            parts = [self._text_score(f, w * idf(max(every.values()), blended[f]), [t]) for f, w in texts]
            parts += [self.score({"match": {f: {"query": t, "boost": w}}}) for f, w in others]
            terms.append(_dis_max(parts, tie))
        return _sum(terms)

    def _nested(self, p: dict) -> Column:
        path, mode = p["path"], p.get("score_mode", "avg")
        field, used = self.qc._lookup(self.schema, path.split(".")) or (None, 0)
        if mode == "none" or field is None or used != len(path.split(".")) or not isinstance(field.dataType, ArrayType) or self.nested:
            return F.lit(1.0 if mode != "none" else 0.0)
        array = self.prepared[path][0] if path in self.prepared else F.coalesce(_quoted(field.name), F.array().cast(field.dataType))
        self.nested.append((path, array))
        try:
            hits = F.filter(array, lambda x: self._inside(x, lambda: F.coalesce(self.qc.compile(p["query"]), F.lit(False))))
            scores = F.transform(hits, lambda x: self._inside(x, lambda: self.score(p["query"], root=True).cast("double")))
        finally:
            self.nested.pop()
        return _joined(scores, mode)


def _marked_element(schema: StructType, path: str, keys: list[tuple[str, str]]) -> Callable[[Column], Column]:
    def element(x: Column) -> Column:
        qc = QueryCompiler(schema)
        qc._scopes.append((path, x, schema[path].dataType.elementType))
        return F.struct(x.alias("e"), *[A.tokens(qc.view(sub).column, A.ANALYZERS[name]).alias(f"m{j}") for j, (sub, name) in enumerate(keys)])
    return element


def _nested_texts(df: DataFrame, schema: StructType, touched: dict[str, dict]) -> tuple[DataFrame, dict]:
    """``df`` with an array of nested objects and their marked texts for each
    path of ``touched``; made in a generator, as ``marked_texts`` are."""
    made, out = [], {}
    for i, (path, passes) in enumerate(touched.items()):
        keys = [key for key, (n, _) in passes.items() if n > 1]
        field = schema[path]

        if keys:
            array = F.coalesce(_quoted(field.name), F.array().cast(field.dataType))
            made.append(F.transform(array, _marked_element(schema, path, keys)).alias(f"__nested{i}"))
            out[path] = (F.col(f"__nested{i}"), keys)
    return (df.select("*", F.inline(F.array(F.struct(*made)))) if made else df), out


def _joined(scores: Column, mode: str) -> Column:
    """One score of an array of scores."""
    if mode == "max":
        return F.array_max(scores)
    if mode == "min":
        return F.array_min(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda a, v: a + v)
    if mode == "sum":
        return total
    if mode != "avg":
        raise ValueError(f"score_mode {mode!r} is not supported")
    return total / F.size(scores)


def _listed(v) -> list:
    return [] if v is None else list(v) if isinstance(v, list) else [v]


def _sum(cs: list[Column]) -> Column:
    if not cs:
        return F.lit(0.0)
    out = cs[0]
    for c in cs[1:]:
        out = out + c
    return out


def _dis_max(cs: list[Column], tie: float) -> Column:
    if not cs:
        return F.lit(0.0)
    best = F.greatest(*cs) if len(cs) > 1 else cs[0]
    return best + F.lit(tie) * (_sum(cs) - best) if tie else best


def search(df: DataFrame, query, track_scores: bool = False, k1: float = K1,
           b: float = B, checkpoint: bool = False) -> DataFrame:
    """Documents matching ``query`` with a ``_score`` column.

    Without ``track_scores`` the score is null (as a sliced scan returns
    it).  With it: BM25 over the whole of ``df`` for full-text leaves, terms on
    keywords and phrases, 1 (times boost) for other leaves, ``bool`` = sum of
    must and should, ``dis_max`` / best-fields ``multi_match`` = best plus
    tie-breaker, most-fields = sum.  ``checkpoint`` stores the marked texts
    between the two passes.
    """
    q = to_query_dict(query) or {"match_all": {}}
    base = df.drop("_score") if "_score" in df.columns else df
    if not track_scores:
        return base.where(query_column(q, base.schema)).withColumn("_score", F.lit(None).cast("double"))
    cols = [_quoted(c) for c in base.columns]
    scorer = _Scorer(base.schema, k1, b)
    scorer.score(q, root=True)
    need, nested = dict(scorer.qc.touched), scorer.nested_touched

    def marked(rows: DataFrame) -> DataFrame:
        rows, scorer.qc.marks = marked_texts(rows, need, split=True)
        rows, scorer.prepared = _nested_texts(rows, base.schema, nested)
        return rows
    # again with the marked texts: the figures of all documents first, then the
    # scores; texts that don't match are not marked again
    scorer = _Scorer(base.schema, k1, b)
    everything = marked(base)
    if checkpoint:
        shared_dir(df.sparkSession)
        everything = everything.checkpoint(eager=True)
    scorer.score(q, root=True)
    scorer.stats.read(everything)
    hits = everything.where(scorer.qc.compile(q)) if checkpoint else marked(where_query(base, q))
    return hits.select(*cols, scorer.score(q, root=True).cast("double").alias("_score"))


def bm25(df: DataFrame, field: str, query: str, keep: Iterable[str] | None = None,
         k1: float = K1, b: float = B, only_matching: bool = True,
         checkpoint: bool = False) -> DataFrame:
    """``keep`` columns plus ``_score`` for the documents of ``df``.

    ``query`` is analyzed like the field.  With ``only_matching`` (the match
    query's OR semantics) documents without any query term are dropped.
    """
    keep = list(keep) if keep is not None else [c for c in df.columns if c != field]
    terms = sorted(set(A.analyze(query)))
    if not terms:
        return df.select(*map(_quoted, keep), F.lit(None).cast("double").alias("_score")).where(F.lit(not only_matching))
    q = {"match": {field: " ".join(terms)}}
    if not only_matching:
        q = {"bool": {"must": [{"constant_score": {"filter": {"match_all": {}}, "boost": 0}}], "should": [q]}}
    text = df.select(*{c: _quoted(c) for c in [*keep, field]}.values())
    return search(text, q, True, k1, b, checkpoint).select(*map(_quoted, keep), "_score")


def search_nested(parent: DataFrame, children: DataFrame, parent_key: str, child_key: str, path: str, query,
                  score_mode: str = "avg", k1: float = K1, b: float = B) -> DataFrame:
    """``nested`` with scores over nested objects kept as a child table:
    matching parents with ``_score``.

    The children are scored as documents; their scores are joined per parent
    in a partial aggregate, so a parent with very many children costs one row
    a task, and the parents with matches are found by one join.
    """
    join = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min}.get(score_mode)
    if join is None:
        raise ValueError(f"score_mode {score_mode!r} is not supported")
    scored = search(children, _below(to_query_dict(query), path), True, k1, b)
    best = scored.groupBy(F.col(child_key).alias(parent_key)).agg(join("_score").alias("_score"))
    return (parent.drop("_score") if "_score" in parent.columns else parent).join(best, parent_key)


def _below(q, path: str):
    """A query on ``path.x`` as a query on ``x``."""
    if isinstance(q, list):
        return [_below(x, path) for x in q]
    if not isinstance(q, dict):
        return q
    out = {}
    for k, v in q.items():
        if k == "field" and isinstance(v, str):
            v = v.removeprefix(path + ".")
        elif k == "fields" and isinstance(v, list):
            v = [x.removeprefix(path + ".") for x in v]
        out[k.removeprefix(path + ".")] = _below(v, path)
    return out
