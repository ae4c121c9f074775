"""Benchmark decontamination: test items found in training documents.

The items' word windows form a hash set that is broadcast, as long as its counted
size allows it (a shuffle join serves beyond). Every window of every document probes
it, the few hits are verified word by word against the document, and give the hit
words, the items, and the text without them. DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tricycle.llm.words import lower_ascii

WINDOW_WORDS = 10
# Windows of a benchmark that is broadcast, about 200 bytes each.
BROADCAST_WINDOWS = 500_000

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # between words of a lower-cased text
GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def benchmark_words(text: Column | str) -> Column:
    """Lower-cased words of letters, digits and characters beyond ASCII; none for null."""
    words = F.array_remove(F.split(lower_ascii(text), GAP), "")
    return F.coalesce(words, F.array().cast("array<string>"))


def _keys(docs: DataFrame) -> DataFrame:
    """``id, row`` tell rows apart (equal rows share them); ``doc`` has all columns."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(F.col("doc_id").isNull(), F.col("text").cast("string")).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.struct("*").alias("doc"),
    )


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """``(hash, words, window, items)``: each distinct window of ``size`` words, or of
    all words of a shorter item, with the ids of its items; an item with a null id adds
    its windows, but no id.
    """
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), benchmark_words(F.col("text").cast("string")).alias("w")
    )
    return (
        words.where("size(w) > 0")
        .select("item_id", F.explode(F.expr(f"transform(sequence(0, greatest(size(w) - {size}, 0)), i -> slice(w, i + 1, {size}))")).alias("window"))
        .groupBy("window")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .select(F.xxhash64("window").alias("hash"), F.size("window").alias("words"), "window", "items")
    )


def _hits(rows: DataFrame, windows: DataFrame, words: int) -> DataFrame:
    """``(id, row, start, window, items)``: windows of ``words`` words whose hash is in
    the set; ``start`` counts words from 0.
    """
    probes = (
        rows.select("id", "row", benchmark_words("text").alias("w"))
        .select(
            "id",
            "row",
            F.posexplode(
                F.expr(
                    f"if(size(w) < {words}, array(),"
                    f" transform(sequence(0, size(w) - {words}), i -> xxhash64(slice(w, i + 1, {words}))))"
                )
            ).alias("start", "hash"),
        )
    )
    return probes.join(windows.where(f"words = {words}").drop("words"), "hash").drop("hash")


def _scanned(docs: DataFrame, benchmark: DataFrame, size: int, broadcast_windows: int) -> DataFrame:
    """``(doc, n_words, items, spans)`` for each row of ``docs``."""
    rows = _keys(docs)
    windows = benchmark_windows(benchmark, size)
    sizes = windows.groupBy("words").count().collect()  # at most one row for each size up to ``size``
    if sum(x["count"] for x in sizes) <= broadcast_windows:
        windows = F.broadcast(windows)
    hits = [_hits(rows, windows, words) for words in sorted({size} | {x["words"] for x in sizes})]
    found = reduce(DataFrame.union, hits)
    found = found.groupBy("id", "row").agg(F.collect_set(F.struct("start", "window", "items")).alias("hits"))
    # The words are an argument of transform, so that they are made once a row and
    # not, inlined into the lambda function, once a hit.
    verify = "flatten(transform(array(w), x -> filter(hits, h -> slice(x, h.start + 1, size(h.window)) = h.window)))"
    verified = (
        rows.drop("text")
        .join(found, ["id", "row"], "left")
        .withColumn("w", benchmark_words(F.col("doc.text").cast("string")))
        .select(
            "doc",
            F.size("w").cast("long").alias("n_words"),
            F.expr(f"array_sort({verify})").alias("hits"),
        )
    )
    merged = """aggregate(hits, array(struct(0 AS first, 0 AS after)), (done, h) -> if(
        h.start <= element_at(done, -1).after,
        concat(slice(done, 1, size(done) - 1), array(struct(element_at(done, -1).first AS first,
            greatest(element_at(done, -1).after, h.start + size(h.window)) AS after))),
        concat(done, array(struct(h.start AS first, h.start + size(h.window) AS after)))))"""
    return verified.select(
        "doc",
        "n_words",
        F.expr("coalesce(array_sort(array_distinct(flatten(transform(hits, h -> h.items)))), array())").alias("items"),
        F.expr(f"coalesce(filter({merged}, s -> s.first < s.after), array())").alias("spans"),
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, broadcast_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, spans, cleaned)`` for each row of ``docs``.

    A word is hit if it lies in an occurrence of a window of ``size`` consecutive
    words of an item; an item of fewer words, but not none, is one window.
    ``items`` are the ids, as sorted strings, of the items with such windows,
    ``spans`` the hit ranges ``(first, after)`` in words from 0, not overlapping, and
    ``cleaned`` the text without hit words and the gaps behind them.

    Null and empty texts have no words, and ``cleaned`` stays null for a null text.
    Repeated rows give as many equal rows; a null doc_id is a row of its own. Words
    that items with a null id share are hit, but such items are not among ``items``; items
    without words are ignored; an item_id that occurs several times counts once. Empty tables and further columns do no harm.
    """
    return _scanned(docs.select("doc_id", "text"), benchmark, size, broadcast_windows).select(
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        "n_words",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.after - s.first)").alias("n_hit"),
        "items",
        "spans",
        F.when(F.size("spans") == 0, F.col("doc.text")).otherwise(_without("doc.text", "spans")).alias("cleaned"),
    )


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, broadcast_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """``docs`` without the rows in which a window of an item occurs, with an id or
    without; all columns stay.
    """
    return _scanned(docs, benchmark, size, broadcast_windows).where("size(spans) = 0").select("doc.*")


def _without(text: str, spans: str) -> Column:
    """The text without the words of the spans and the gaps behind them."""
    # Parts and gaps alternate; the first part is empty if the text starts with a gap.
    parts, gaps = f"split({text}, r'{GAP_ANY_CASE}', -1)", f"regexp_extract_all({text}, r'({GAP_ANY_CASE})', 1)"
    shift = f"if({text} RLIKE r'^{GAP_ANY_CASE}', 1, 0)"
    return F.expr(
        f"aggregate(array(struct({parts} AS p, {gaps} AS g, {shift} AS z, {spans} AS s)), '', (x, t) -> array_join("
        "transform(sequence(1, size(t.p)), i -> if("
        "exists(t.s, s -> i - 1 - t.z >= s.first AND i - 1 - t.z < s.after), '',"
        " concat(t.p[i - 1], coalesce(get(t.g, i - 1), '')))), ''))"
    )
