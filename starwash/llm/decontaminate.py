"""Benchmark decontamination by a hash set of normalised n-grams.

Words are runs of ``[a-z0-9]`` and non-ASCII characters after lower-casing A-Z. A
benchmark item gives its windows of ``n`` consecutive words (all its words if
they are fewer).

A window of n words holds, wherever it starts, a whole block of s = (n + 1) // 2
words that starts at a multiple of s in the document. So the hash set has the
s-word blocks of the benchmark's windows, at every offset, and documents are
scanned at every s-th word only: all texts whole, in one narrow pass, in which
nothing is shuffled but hits. The hash set is broadcast only if it has at most
``max_broadcast`` blocks (counted first); a larger one is joined by shuffling.
Around each hit all windows that contain the block are compared word by word with
the benchmark's windows.

Documents are keyed by a hash of their text, so copies and rows that share an id
are each judged right, and a group of copies is one key whose hits are combined
before any shuffle.

Defined cases: null and empty texts have no words; items without words have no
windows; items with a null id hit, but are not listed or counted; repeated items
and rows are each judged; an empty benchmark hits nothing. Output columns replace
input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import lower_ascii, save, text_or_empty

#: what stands between words, after lower-casing; and before it
_BETWEEN, _BETWEEN_ANY_CASE = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_WORD_ANY_CASE = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_OUT = ("n_words", "n_hit", "n_items", "items", "spans", "contaminated")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), _BETWEEN), "")


def _key(text: Column) -> tuple[Column, Column]:
    """128 bits of a text: two hashes with different seeds."""
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")


def benchmark_windows(benchmark: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(size, window, items): the distinct windows with the ids that have them."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(text_or_empty(text_col)).alias("w"))
    items = items.filter(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(n)))
    cut = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1),
                      lambda i: F.array_join(F.slice("w", i, F.col("size")), " "))
    return (items.select("item", "size", F.explode(cut).alias("window")).groupBy("size", "window")
            .agg(F.array_sort(F.collect_set("item")).alias("items")))


def _block(size: int) -> int:
    return (size + 1) // 2


def _blocks_of(size: int, words: str) -> Column:
    """The aligned blocks (at, s, h) of a document for windows of ``size`` words."""
    s = _block(size)
    starts = F.sequence(F.lit(0), F.size(words) - s, F.lit(s))
    hashed = F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(s).alias("s"), F.xxhash64(F.slice(words, i + 1, s)).alias("h")))
    return F.when(F.size(words) >= s, hashed).otherwise(F.array().cast("array<struct<at:int,s:int,h:bigint>>"))


def _windows_around(size: int, words: str) -> Column:
    """Of a hit block at ``at``: the windows of ``size`` words that contain it, as (at, size, window)."""
    first, last = F.greatest(F.lit(0), F.col("at") - (size - _block(size))), F.least(F.col("at"), F.size(words) - size)
    cut = F.transform(F.sequence(first, last), lambda i: F.struct(
        i.alias("at"), F.lit(size).alias("size"), F.array_join(F.slice(words, i + 1, size), " ").alias("window")))
    return F.when((F.col("s") == _block(size)) & (first <= last), cut).otherwise(
        F.array().cast("array<struct<at:int,size:int,window:string>>"))


def mark(documents: DataFrame, benchmark: DataFrame, n: int = 10, max_broadcast: int = 1_000_000,
         text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``documents`` with n_words, n_hit, n_items, items (sorted ids as strings),
    spans (sorted, merged word ranges ``from``/``to``, end exclusive) and contaminated."""
    windows = save(benchmark_windows(benchmark, n, item_col, item_text_col), "windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most n numbers
    in_window = F.array().cast("array<struct<s:int,h:bigint>>")
    for size in sizes:
        s = _block(size)
        cut = F.array(*[F.struct(F.lit(s).alias("s"), F.xxhash64(F.slice("w", k + 1, s)).alias("h")) for k in range(size - s + 1)])
        in_window = F.when(F.col("size") == size, cut).otherwise(in_window)
    blocks = windows.select("size", F.split("window", " ").alias("w")).select(F.explode(in_window).alias("x")).select("x.*").distinct()
    blocks = save(blocks.withColumn("found", F.lit(True)), "blocks")
    small = blocks.count() <= max_broadcast
    keep = [c for c in documents.columns if c.lower() not in _OUT]

    text = text_or_empty(text_col)
    texts = documents.select(*_key(text), words_of(text).alias("w"))
    # the first element keeps every row, with its number of words
    counted = F.array(F.struct(F.lit(-1).alias("at"), F.size("w").alias("s"), F.lit(None).cast("long").alias("h")))
    arrays = [counted] + [_blocks_of(size, "w") for size in {_block(x): x for x in sizes}.values()]
    every = texts.select("k1", "k2", F.explode(F.concat(*arrays)).alias("x")).select("k1", "k2", "x.*")
    scan = every.join(F.broadcast(blocks) if small else blocks, ["s", "h"], "left").filter("found or at = -1")
    scan = save(scan.groupBy("k1", "k2").agg(
        F.max(F.when(F.col("at") == -1, F.col("s"))).alias("n_words"),
        F.collect_set(F.when(F.col("at") >= 0, F.struct("at", "s"))).alias("hits")), "scan")

    hit = scan.filter(F.size("hits") > 0).select("k1", "k2", "hits")
    again = documents.select(text.alias("t")).select("t", *_key(F.col("t"))).join(hit, ["k1", "k2"])
    again = again.select("k1", "k2", words_of(F.col("t")).alias("w"), F.explode("hits").alias("x")).select("k1", "k2", "w", "x.*")
    around = F.concat(*[_windows_around(size, "w") for size in sizes] or [F.array().cast("array<struct<at:int,size:int,window:string>>")])
    found = again.select("k1", "k2", F.explode(around).alias("x")).select("k1", "k2", "x.*").distinct()
    found = found.join(windows.select("size", "window", "items"), ["size", "window"])
    found = found.groupBy("k1", "k2").agg(
        F.array_sort(F.collect_set(F.struct(F.col("at").alias("from"), (F.col("at") + F.col("size")).alias("to")))).alias("raw"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    merged = F.aggregate(
        "raw", F.array().cast("array<struct<from:int,to:int>>"),
        lambda done, x: F.when((F.size(done) > 0) & (F.element_at(done, -1)["to"] >= x["from"]),
                               F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                                   F.element_at(done, -1)["from"].alias("from"),
                                   F.greatest(F.element_at(done, -1)["to"], x["to"]).alias("to")))))
        .otherwise(F.concat(done, F.array(x))))
    # written, so that the last join has no aggregation under it and Spark can split a text that many rows have
    result = save(scan.select("k1", "k2", "n_words").join(found.select("k1", "k2", "items", merged.alias("spans")), ["k1", "k2"], "left"), "hits")

    # input columns ride in a struct, so that none can clash with those used here
    out = documents.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(7), text).alias("_k2"))
    out = out.join(result, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")))
    spans = F.coalesce("spans", F.array().cast("array<struct<from:int,to:int>>"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in keep], F.col("n_words").cast("long").alias("n_words"),
                      F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x["to"] - x["from"]).alias("n_hit"),
                      F.size(items).cast("long").alias("n_items"), items.alias("items"), spans.alias("spans"),
                      (F.size(spans) > 0).alias("contaminated"))


def remove_spans(marked: DataFrame, text_col: str = "text") -> DataFrame:
    """Texts without the words of ``spans`` (and what stands between them)."""
    text = text_or_empty(text_col)
    word, gap = F.array_remove(F.split(text, _BETWEEN_ANY_CASE), ""), F.split(text, _WORD_ANY_CASE, -1)
    hit = lambda i: F.exists("spans", lambda s: (s["from"] <= i) & (i < s["to"]))
    inner = lambda i: F.exists("spans", lambda s: (s["from"] < i) & (i < s["to"]))
    parts = F.transform("_w", lambda w, i: F.concat(F.when(inner(i), "").otherwise(F.element_at("_g", i + 1)), F.when(hit(i), "").otherwise(w)))
    return (marked.withColumns({"_w": word, "_g": gap})
            .withColumn(text_col, F.when(F.size("spans") == 0, F.col(text_col)).otherwise(
                F.concat(F.array_join(parts, ""), F.element_at("_g", -1)))).drop("_w", "_g"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, mode: str = "documents", **options) -> DataFrame:
    """Remove the contaminated ``documents``, or only the hit ``spans`` of their texts."""
    marked = mark(documents, benchmark, **options)
    marked = marked.filter(~F.col("contaminated")) if mode == "documents" else remove_spans(marked, options.get("text_col", "text"))
    return marked.select(*[c for c in documents.columns if c.lower() not in _OUT])
