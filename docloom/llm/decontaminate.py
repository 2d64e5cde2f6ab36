"""Benchmark decontamination by SimHash over windows of an item's size.

1. Windows. An item of n words is held against every run of n words of a document. A window
   is worth a fingerprint only if enough of its shingles occur in items of that size: two
   lists of m shingles with weighted similarity t share at least 2tm / (1 + t) of them. That
   bound is exact, so no window that could reach the similarity is left out.
2. Fingerprints. Each bit of a window's SimHash is the majority of that bit over its
   shingles, repeated ones counting as often as they occur.
3. Candidates. Fingerprints are cut into eight bytes. If two differ in at most ``RADIUS``
   bits, some byte differs in at most ``RADIUS // 8``; items are indexed under every such
   neighbour of each byte, so all fingerprints within the radius meet.
4. Confirmation: sum of the lesser over sum of the greater shingle counts of window and item.

At a similarity of 0.8 about 10 of 64 bits differ, with a deviation of 3; the radius lies more
than four deviations above that. Everything is DataFrame expressions.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import columns_of, fits, free_name, joined_small, let, saved

SHINGLE = 5
RADIUS = 23
BYTES = 8
#: Items up to which the index of their fingerprints (296 short rows each) is broadcast.
BROADCAST_ITEMS = 1000


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(listed: Column, size: Column | int) -> Column:
    """A hash of each run of ``size`` words, in order; empty if there are fewer words."""
    size = F.lit(size) if isinstance(size, int) else size

    def hashed(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.xxhash64(F.slice(w, i, size)))
        return F.when(F.size(w) >= size, runs).otherwise(F.expr("cast(array() as array<long>)"))

    return let(listed, hashed)


def simhash(hashes: Column) -> Column:
    """64 bits, each the majority of that bit over all hashes."""
    values = F.array(*[F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long") for b in range(64)])

    def bit(acc: Column, b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0).cast("long"), lambda n, h: n + F.call_function("getbit", h, b))
        return F.when(2 * ones > F.size(hashes), acc + F.element_at(values, b + 1)).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), bit)


def _byte(fingerprint: Column, i: int) -> Column:
    return F.shiftrightunsigned(fingerprint, 8 * i).bitwiseAND(F.lit(255).cast("long"))


def shared_weight(a: Column, b: Column) -> Column:
    """Sum over all shingles of the lesser number of occurrences in the two lists."""
    def lesser(acc: Column, x: Column) -> Column:
        return acc + F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x)))

    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(F.aggregate(F.array_distinct(b), F.lit(0), lesser))


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    rows = columns_of(benchmark, item_id=item_col, text=text_col).select("item_id", words(F.col("text")).alias("w"))
    rows = rows.where("size(w) > 0 AND item_id IS NOT NULL").withColumn("size", F.least(F.lit(SHINGLE), F.size("w")))
    rows = rows.select("item_id", "size", shingles(F.col("w"), F.col("size")).alias("item"))
    return saved(rows.select("*", F.size("item").alias("m"), simhash(F.col("item")).alias("item_print")), "items")


def _window_starts(hits: Column, m: Column, there: Column, percent: int) -> Column:
    """Starts of the windows that hold enough of the sorted places ``hits``, among ``there`` shingles."""
    width = F.least(m, there)
    need = F.ceil(percent * (m + width) / F.lit(100.0 + percent)).cast("int")
    many = F.size(hits) - need

    def starts(j: Column) -> Column:
        first, last = F.element_at(hits, j + 1), F.element_at(hits, j + need)
        low, high = F.greatest(F.lit(0), last - width + 1), F.least(first, there - width)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.expr("cast(array() as array<int>)"))

    found = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), many), starts)))
    return F.when(many >= 0, found).otherwise(F.expr("cast(array() as array<int>)"))


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_windows) of every document with a passage like an item.

    A passage is a window of as many words as the item (the whole document, if it is shorter), its
    similarity that of the two lists of five-word shingles; items of fewer words are one shingle. ``start_word`` is the
    first of the best windows, ``n_windows`` counts the windows that reach ``percent``.

    Null or wordless texts and items match nothing, rows with a null id are left out. Repeated rows count
    once; texts that share an id count together. Empty tables give an empty result. Other columns are ignored.
    """
    items = _items(benchmark, item_col, item_text_col)
    rows = columns_of(docs, doc_id=id_col, text=text_col).where("doc_id IS NOT NULL AND text IS NOT NULL")
    rows = rows.withColumn("body", F.xxhash64("text"))
    sizes = [r["size"] for r in items.select("size").distinct().collect()]  # at most five numbers
    if not sizes:
        sizes = [SHINGLE]
    lists = rows.select("doc_id", "body", words(F.col("text")).alias("w"))
    runs = lists.select("doc_id", "body", F.explode(F.array(*[
        F.struct(F.lit(k).alias("size"), shingles(F.col("w"), k).alias("all")) for k in sizes])).alias("run"))
    spread = runs.select("doc_id", "body", F.col("run.size").alias("size"), F.size("run.all").alias("there"),
                         F.posexplode("run.all").alias("place", "shingle"))
    known = items.select("size", "m", F.explode("item").alias("shingle")).distinct()
    hits = joined_small(spread, known, ["size", "shingle"], rows=200_000)
    starts = hits.groupBy("doc_id", "body", "size", "m").agg(
        F.array_sort(F.collect_set("place")).alias("hits"), F.max("there").alias("there"))
    starts = starts.select("doc_id", "body", "size", "m", _window_starts(F.col("hits"), F.col("m"), F.col("there"), percent).alias("starts"))
    starts = saved(starts.where("size(starts) > 0"), "windows")

    texts = rows.distinct().join(starts, ["doc_id", "body"])
    windows = texts.select("doc_id", "size", "m", "starts", shingles(words(F.col("text")), F.col("size")).alias("all"))
    windows = windows.select("doc_id", "size", "m", "all", F.explode("starts").alias("start"))
    windows = windows.select("doc_id", "size", "m", "start", F.slice("all", F.col("start") + 1, F.col("m")).alias("window"))
    windows = windows.withColumn("print", simhash(F.col("window")))
    return _confirmed(windows, items, percent)


def _confirmed(windows: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    flips = RADIUS // BYTES
    masks = [sum(1 << b for b in chosen) for n in range(flips + 1) for chosen in combinations(range(8), n)]
    blocks = F.array(*[F.struct(F.lit(i).alias("block"), _byte(F.col("print"), i).alias("value")) for i in range(BYTES)])
    probes = F.array(*[F.struct(F.lit(i).alias("block"), _byte(F.col("item_print"), i).bitwiseXOR(F.lit(mask).cast("long")).alias("value"))
                       for i in range(BYTES) for mask in masks])
    index = items.select("size", "m", "item_id", "item_print", F.inline(probes))
    probed = windows.select("*", F.inline(blocks))
    index = F.broadcast(index) if fits(items, BROADCAST_ITEMS) else index
    differ = F.col("print").bitwiseXOR(F.col("item_print"))
    # A pair meets under every byte that is near enough; it counts under the first of them.
    first = F.coalesce(*[F.when(F.bit_count(_byte(differ, i)) <= flips, F.lit(i)) for i in range(BYTES)])
    near = probed.join(index, ["size", "m", "block", "value"]).where((first == F.col("block")) & (F.bit_count(differ) <= RADIUS))
    near = joined_small(near.drop("item_print", "block", "value"), items.select("item_id", "item").withColumnRenamed("item_id", "other"),
                        F.col("item_id") == F.col("other"), rows=BROADCAST_ITEMS)
    weighed = near.select("doc_id", "item_id", "start", shared_weight(F.col("window"), F.col("item")).alias("both"),
                          (F.size("window") + F.size("item")).alias("sizes"))
    weighed = weighed.where(100 * F.col("both") >= percent * (F.col("sizes") - F.col("both")))
    similarity = F.col("both") / (F.col("sizes") - F.col("both"))
    return weighed.groupBy("doc_id", "item_id").agg(
        F.max(similarity).alias("similarity"), F.max_by("start", F.struct(similarity, -F.col("start"))).alias("start_word"),
        F.countDistinct("start").alias("n_windows"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of documents without such a passage, with all their columns, whatever these are called.

    A null or empty text has no passage and stays; so do rows with a null id. Rows that repeat an id go if one of their texts has one.
    """
    name = free_name(docs, "_found")
    found = matches(docs, benchmark, percent, id_col, text_col).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(found, F.col(f"`{id_col}`") == F.col(name), "left_anti")
