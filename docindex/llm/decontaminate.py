"""Benchmark decontamination, in DataFrame functions only.

Benchmark items are cut into windows of ``width`` consecutive words (a shorter
item is one window).  Hashes of all distinct windows form a set that is sent
to every task once its size is known to be small; each task hashes every
window of its documents inside generated code and looks it up.  Found windows
are verified word by word.  Documents, or the words
inside found windows, can then be removed.

Only A-Z are lower-cased, letter by letter, on both sides: lower() looks at a
letter's neighbours (a Greek sigma at the end of a word), so the same word could
come out otherwise inside a text than in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Words are runs of anything but ASCII controls, blanks and punctuation.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Beyond so many windows the set is not broadcast but joined by hash.
MOST_BROADCAST = 1_000_000


def words_of(text: Column) -> Column:
    """The words of a text, in their own case; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR, -1), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _window(words: Column, at: Column, width: Column) -> Column:
    """``width`` words from position ``at`` (position -1 has width 0)."""
    return F.slice(words, F.greatest(at + 1, F.lit(1)), width)


def _key(window: Column, width: Column) -> Column:
    return F.xxhash64(width, window)


def _spots(positions: Column, width: int) -> Column:
    return F.transform(positions, lambda i: F.struct(i.alias("i"), F.lit(width).alias("m")))


def windows_of(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct windows: w (words, lower-case, joined by blanks), m (number
    of words), items (ids as strings, nulls left out)."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(lower_ascii(F.col("text").cast("string"))).alias("words"))
    cut = (words.where(F.size("words") > 0).withColumn("m", F.least(F.size("words"), F.lit(width)))
           .select("item", "m", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("m"))).alias("i"))
           .select("item", "m", F.concat_ws(" ", F.slice("words", F.col("i") + 1, F.col("m"))).alias("w")))
    return cut.groupBy("w", "m").agg(F.collect_set("item").alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, text_key (hash of the
    text), n_words, hit (positions of the words inside found windows, in
    order) and items (ids of items with found windows, sorted as strings).

    Null and blank texts have no words; so have such items.  Rows that repeat
    a doc_id with its text give equal rows, as many as there are; a doc_id
    with other texts gives a row for each.  Items that share an id count once,
    items without id mark words only.  An empty benchmark finds nothing.
    """
    wins = stored(windows_of(benchmark, width), "windows")
    # figures of the benchmark: at most ``width`` rows
    sizes = {r.m: r.n for r in wins.groupBy("m").agg(F.count("*").alias("n")).collect()}
    keys = wins.select(_key(F.split("w", " "), F.col("m")).alias("key"), "m", "w", "items")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id"), text.alias("text"), words_of(lower_ascii(text)).alias("words")).withColumn("n", F.size("words"))
    # position -1 stands for the document itself and always passes
    none = F.array().cast("array<string>")
    document = base.select("doc_id", F.xxhash64("text", F.length("text")).alias("text_key"), F.lit(-1).alias("i"), F.lit(0).alias("m"), "n", none.alias("items"))
    if not sizes:
        found = document
    else:
        small = sum(sizes.values()) <= MOST_BROADCAST
        mark = keys.select("key", "m", "w", "items").unionByName(
            docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("key"), F.lit(0).alias("m"), F.lit("").alias("w"), none.alias("items")))
        spots = F.array(F.struct(F.lit(-1).alias("i"), F.lit(0).alias("m")))
        if len(sizes) == 1:
            spot = F.explode(F.concat(F.array(F.lit(-1)), F.when(F.col("n") >= min(sizes), F.sequence(F.lit(0), F.col("n") - min(sizes))).otherwise(F.array().cast("array<int>")))).alias("i")
            scan = base.select("doc_id", "text", "words", "n", spot).withColumn("m", F.when(F.col("i") < 0, 0).otherwise(min(sizes)))
        else:
            for m in sorted(sizes):
                spots = F.concat(spots, F.when(F.col("n") >= m, _spots(F.sequence(F.lit(0), F.col("n") - m), m)).otherwise(F.slice(spots, 1, 0)))
            scan = base.select("doc_id", "text", "words", "n", F.explode(spots).alias("s")).select("doc_id", "text", "words", "n", "s.i", "s.m")
        mark = mark.withColumnRenamed("m", "bm")
        scan = scan.withColumn("key", F.when(F.col("i") < 0, F.lit(0).cast("long")).otherwise(_key(_window(F.col("words"), F.col("i"), F.col("m")), F.col("m"))))
        said = F.concat_ws(" ", _window(F.col("words"), F.col("i"), F.col("m")))
        text_key = F.xxhash64("text", F.length("text")).alias("text_key")
        if small:
            hits = scan.join(F.broadcast(mark), "key")
            hits = hits.where((F.col("m") == F.col("bm")) & ((F.col("i") < 0) | (said == F.col("w"))))
            found = hits.select("doc_id", text_key, "i", "m", "n", "items")
        else:
            # narrow rows: the window travels instead of the document
            narrow = scan.where("i >= 0").select("doc_id", text_key, "i", "m", "n", "key", said.alias("v"))
            found = (narrow.join(mark, "key").where("m = bm and v = w").select("doc_id", "text_key", "i", "m", "n", "items").unionByName(document))
    out = found.groupBy("doc_id", "text_key").agg(
        F.max("n").cast("long").alias("n_words"), F.sum((F.col("i") < 0).cast("int")).alias("copies"),
        F.collect_set(F.when(F.col("i") >= 0, F.struct("i", "m"))).alias("spots"), F.collect_set("items").alias("lists"))
    hit = F.array_sort(F.array_distinct(F.flatten(F.transform("spots", lambda s: F.sequence(s.i, s.i + s.m - 1)))))
    return (out.select("doc_id", "text_key", "n_words", hit.alias("hit"), F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items"), "copies")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy", "copies"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, remove: str = "documents") -> DataFrame:
    """``docs`` without documents that contain a benchmark window, or
    (``remove="spans"``) with the words inside such windows cut out of the
    text.  Columns stay as they are, whatever their names; clean documents are
    left alone, null and empty texts among them.  Repeated rows go together;
    texts are searched whole."""
    found = contamination(docs.select("doc_id", "text"), benchmark, width).where(F.size("hit") > 0)
    found = stored(found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("hit").alias("__hit")).distinct(), "found")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    same = F.col("row.doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(text, F.length(text)) == F.col("__key"))
    if remove == "documents":
        return rows.join(found, same, "left_anti").select("row.*")
    words = F.array_remove(F.split(text, SEPARATOR, -1), "")
    gaps = F.split(text, WORD, -1)
    kept = F.concat(F.array_join(F.transform(words, lambda w, i: F.concat(F.get(gaps, i), F.when(F.array_contains("__hit", i), F.lit("")).otherwise(w))), ""), F.get(gaps, F.size(words)))
    cut = rows.join(found, same, "left")
    return cut.select(*(F.when(F.col("__hit").isNull(), F.col("row.text")).otherwise(kept).alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))
