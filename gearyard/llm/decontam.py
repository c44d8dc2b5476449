"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by size. Each item keeps a MinHash sketch: its smallest
shingle hashes, as many as its partition's sizes need so that no document that
holds the demanded share of the item can miss all of them. Documents probe the
sketches with all their shingles, so an item is found in a text of any length;
candidates are then verified by exact shingle containment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearyard.llm.common import stored, words

WIDTH = 5
CONTAINMENT = 0.8
# Item tables up to this many rows (a few dozen MB) are broadcast; larger ones join by shuffle.
BROADCAST_ROWS = 1_000_000


def shingles(text: Column, width: int = WIDTH) -> Column:
    """All windows of ``width`` words, in lower case, as structs of words."""
    w = words(F.lower(text))
    size = F.greatest(F.size(w) - (width - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(w, F.lit(k + 1), size).alias(f"w{k}") for k in range(width)])


def text_key(text: Column) -> list[Column]:
    """96 bits that stand for a text, from two unrelated hashes; NULL is empty."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("_k1"), F.hash(text).alias("_k2")]


def _bounded(df: DataFrame) -> DataFrame:
    """A stored table with a broadcast hint if it is small enough to have one."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def item_shingles(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, n_shingles, shingle, hash): distinct shingles of distinct items.

    Items of equal words are one, under the smallest id (NULL is the largest).
    """
    told = items.select("item_id", F.array_join(words(F.lower("text")), " ").alias("_t"))
    one = told.groupBy("_t").agg(F.min("item_id").alias("item_id"))
    listed = one.select("item_id", F.monotonically_increasing_id().alias("_item"), F.array_distinct(shingles(F.col("_t"), width)).alias("_s"))
    return listed.select(
        "item_id", "_item", F.size("_s").alias("n_shingles"), F.explode("_s").alias("shingle")
    ).withColumn("hash", F.xxhash64("shingle"))


def sketches(listed: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(item, hash, least): each item's smallest hashes, and the windows a holder has at least.

    Partition p has items of 2**p to 2**(p+1) - 1 shingles. If a share c of n
    shingles is in a document, at most floor((1 - c) * n) are missing, so one
    sketch hash more than that for the partition's largest size cannot all be.
    """
    part = F.floor(F.log2(F.col("n_shingles").cast("double")))
    largest = F.pow(F.lit(2.0), part + 1) - 1
    length = (F.floor((1 - containment) * largest + 1e-9) + 1).cast("int")
    least = F.ceil(containment * F.pow(F.lit(2.0), part) - 1e-9).cast("int")
    by_item = listed.groupBy("_item", "n_shingles").agg(F.sort_array(F.collect_set("hash")).alias("_hashes"))
    return by_item.select(
        "_item", F.explode(F.slice("_hashes", F.lit(1), length)).alias("hash"), least.alias("least")
    )


def _short_items(docs: DataFrame, items: DataFrame, width: int) -> DataFrame | None:
    """(_k1, _k2, item_id, n_shared, n_shingles) for items of 1 to ``width - 1``
    words: such an item is one shingle, its words, and a text holds it if they
    stand in it in a row. Texts probe with windows of the lengths such items have."""
    w = words(F.lower("text"))
    told = items.select("item_id", F.size(w).alias("_n"), F.array_join(w, " ").alias("_key")).filter(
        (F.col("_n") >= 1) & (F.col("_n") < width)
    )
    short = stored(told.groupBy("_key", "_n").agg(F.min("item_id").alias("item_id")), "short-items")
    lengths = sorted(r._n for r in short.select("_n").distinct().collect())  # at most width - 1 values
    if not lengths:
        return None
    found = None
    rows = docs.select(*text_key(F.col("text")), words(F.lower("text")).alias("_w"))
    for k in lengths:
        places = F.when(F.size("_w") >= k, F.sequence(F.lit(1), F.size("_w") - k + 1)).otherwise(F.array().cast("array<int>"))
        grams = F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice("_w", i, k), " ")))
        hits = rows.select("_k1", "_k2", F.explode(grams).alias("_key")).join(
            _bounded(short.filter(F.col("_n") == k).select("_key", "item_id")), "_key"
        )
        hits = hits.select("_k1", "_k2", "item_id")
        found = hits if found is None else found.unionByName(hits)
    return found.distinct().select(
        "_k1", "_k2", "item_id", F.lit(1).cast("long").alias("n_shared"), F.lit(1).alias("n_shingles")
    )


def contaminated_texts(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT,
                       width: int = WIDTH) -> DataFrame:
    """(_k1, _k2, item_id, n_shared, n_shingles): which texts hold which items, each text once.

    Items of fewer words than a shingle are one shingle each: their words, in a row.
    """
    listed = stored(item_shingles(items, width), "items")
    probes = _bounded(stored(sketches(listed, containment), "sketches"))
    rows = docs.select(*text_key(F.col("text")), shingles(F.col("text"), width).alias("_s"))
    windows = rows.select("_k1", "_k2", F.size("_s").alias("_n"), F.explode("_s").alias("_w"))
    hits = windows.select("_k1", "_k2", "_n", F.xxhash64("_w").alias("hash")).join(probes, "hash")
    candidates = stored(
        hits.filter(F.col("_n") >= F.col("least")).select("_k1", "_k2", "_item").distinct(), "candidates"
    )
    suspects = docs.select("text", *text_key(F.col("text"))).join(
        candidates.select("_k1", "_k2").distinct(), ["_k1", "_k2"], "left_semi"
    )
    held = suspects.select("_k1", "_k2", F.explode(shingles(F.col("text"), width)).alias("shingle"))
    # exact: equal words, not only equal hashes; repeats and copies of a text count once
    shared = held.withColumn("hash", F.xxhash64("shingle")).join(_bounded(listed), ["hash", "shingle"]).select(
        "_k1", "_k2", "_item", "item_id", "n_shingles", "hash"
    ).distinct()
    counted = shared.groupBy("_k1", "_k2", "_item", "item_id", "n_shingles").agg(F.count(F.lit(1)).alias("n_shared"))
    long = counted.filter(F.col("n_shared") >= F.col("n_shingles") * containment - 1e-9).join(
        candidates, ["_k1", "_k2", "_item"], "left_semi"
    ).drop("_item")
    short = _short_items(docs, items, width)
    return long if short is None else long.unionByName(short.withColumn("n_shingles", F.col("n_shingles").cast(long.schema["n_shingles"].dataType)))


def find_items(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, width: int = WIDTH) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment) for every document that holds an item.

    Containment is the share of an item's distinct shingles found in the text.
    NULL and empty texts hold nothing; an item of fewer words than a shingle
    is one shingle, found where its words stand in a row; an item without a
    word is never found. Each of several equal rows gets its result; equal
    items are one. Other columns of either table are not looked at.
    """
    found = stored(contaminated_texts(docs.select("text"), items.select("item_id", "text"), containment, width), "leaks")
    return docs.select("doc_id", *text_key(F.col("text"))).join(found, ["_k1", "_k2"]).select(
        "doc_id", "item_id", "n_shared", F.col("n_shingles").cast("long").alias("n_shingles"),
        (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT,
                      width: int = WIDTH) -> DataFrame:
    """The documents that hold no item, with the columns they came with."""
    found = stored(contaminated_texts(docs.select("text"), items.select("item_id", "text"), containment, width), "leaks")
    k1, k2 = text_key(docs["text"])
    leaks = found.select(F.col("_k1").alias("_l1"), F.col("_k2").alias("_l2")).distinct()
    return docs.join(leaks, (k1 == F.col("_l1")) & (k2 == F.col("_l2")), "left_anti")
