"""Mixing sources to target weights with Sainte-Laguë apportionment.

The mix is a number of equal blocks of words. Sources get blocks by highest
quotients of their targets, each source's blocks go to its shards by highest
quotients of the shards' sizes, and in each shard the blocks to take are drawn
by a seeded order. Nothing is ever ranked over documents but inside one shard,
and shards hold a bounded number of words.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gearyard.llm.common import stored, word_count

# A source is cut into shards of about this many words, a mix into this many
# blocks for each shard's worth of words.
SHARD_WORDS = 1_000_000
BLOCKS_PER_SHARD = 4096
MOST_REPEATS = 3


def _draw(*parts: Column | str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *parts)


def row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(*docs.columns).alias("row_hash")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, row_hash): what the mix needs to know of each document."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), row_hash(docs))


def targets(sized: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target): one row per source.

    Sources in code point order, NULL last, weigh as the cycle says. A target
    stops at ``repeats`` times its source's size; what is over is shared by
    weight among the others until none is above. With sources ordered by
    capacity per weight, those that end capped are the first ones, so this
    comes out of running sums. The windows are over one row per source.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*map(F.lit, cycle)), (F.row_number().over(in_order) - 1) % len(cycle) + 1)
    weighed = per_source.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * repeats)
    by_capacity = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_capacity.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    summed = weighed.withColumns({
        "left_words": F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "left_weight": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "place": F.row_number().over(by_capacity),
    })
    capped = F.col("cap") * F.col("left_weight") <= F.col("left_words") * F.col("weight")
    open_place = F.min(F.when(~capped, F.col("place"))).over(whole)
    level = [F.max(F.when(F.col("place") == open_place, F.col(c))).over(whole) for c in ("left_words", "left_weight")]
    share = level[0] * F.col("weight") / level[1]
    return summed.withColumn("_open", open_place).select(
        "source", "source_size",
        F.when(F.col("_open").isNull() | (F.col("place") < F.col("_open")), F.col("cap").cast("double"))
        .otherwise(share).alias("target"),
    )


def sainte_lague(claims: DataFrame, votes: str, seats: Column, group: list[str], tie: list[Column]) -> DataFrame:
    """The claims with their number of ``seats``, by highest quotients votes/(2k+1).

    Seats certain to be won are given at once: with n claims and S seats, no
    claim gets fewer than votes*(S - n/2)/total rounded. The fewer than n seats
    left are drawn by quotient among the next few of each claim: at most four
    rows for each claim.
    """
    within = Window.partitionBy(*group)
    total, n = F.sum(votes).over(within), F.count(F.lit(1)).over(within)
    exact = F.when(F.col("_total") > 0, F.col(votes).cast("double") / F.col("_total")).otherwise(F.lit(0.0))
    first = claims.withColumns({"_total": total.cast("double"), "_n": n, "_seats": seats.cast("double")}).withColumns({
        "_sure": F.greatest(F.lit(0.0), F.ceil(exact * (F.col("_seats") - F.col("_n") / 2) - 0.5)).cast("long"),
        "_more": (F.ceil(exact * F.col("_n")) + 2).cast("int"),
    }).withColumn("_open", F.col("_seats").cast("long") - F.sum("_sure").over(within))
    next_seats = first.select("*", F.explode(F.sequence(F.lit(0), F.col("_more"))).alias("_k"))
    quotient = F.col(votes).cast("double") / (2 * (F.col("_sure") + F.col("_k")) + 1)
    ranked = next_seats.withColumn("_rank", F.row_number().over(
        within.orderBy(F.desc(quotient), *tie, F.asc("_k"))
    ))
    won = F.sum(((F.col("_rank") <= F.col("_open")) & (F.col(votes) > 0)).cast("long"))
    kept = claims.columns
    return ranked.groupBy(*kept).agg((F.max("_sure") + won).alias("seats")).select(*kept, "seats")


def quotas(sized: DataFrame, per_source: DataFrame, shard_words: int, blocks_per_shard: int) -> DataFrame:
    """(source, shard, shard_size, block_words, quota): blocks to take from each shard."""
    all_words = F.sum("source_size").over(Window.partitionBy())  # over one row per source
    plan = per_source.withColumn("all_words", all_words).withColumn(
        "n_blocks", F.ceil(F.col("all_words") / F.lit(shard_words)) * blocks_per_shard
    ).withColumn(
        "block_words", F.greatest(F.lit(1), F.floor(F.col("all_words") / F.greatest("n_blocks", F.lit(1)))).cast("long")
    ).withColumn("all_blocks", F.round(F.col("all_words") / F.col("block_words")))
    seated = sainte_lague(
        plan.withColumn("_one", F.lit(1)), "target", F.col("all_blocks"), ["_one"], [F.asc_nulls_last("source")]
    ).drop("_one").withColumnRenamed("seats", "source_blocks")
    shards = with_shard(sized, per_source, shard_words).groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    known = seated.select(F.col("source").alias("_s"), "block_words", "source_blocks")
    cells = shards.join(known, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return sainte_lague(cells, "shard_size", F.col("source_blocks"), ["source"], [F.asc("shard")]).select(
        "source", "shard", "shard_size", "block_words", F.col("seats").alias("quota")
    )


def with_shard(sized: DataFrame, per_source: DataFrame, shard_words: int) -> DataFrame:
    """Documents with the shard of their source that their hash falls into."""
    count = per_source.select(
        F.col("source").alias("_s"), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long").alias("_shards")
    )
    return sized.join(F.broadcast(count) if _few(per_source) else count, F.col("source").eqNullSafe(F.col("_s"))).withColumn(
        "shard", F.pmod(F.col("row_hash"), F.col("_shards"))
    ).drop("_s", "_shards")


def _few(per_source: DataFrame) -> bool:
    """Whether the sources are few enough to broadcast; else they join by shuffle."""
    return per_source.limit(100_001).count() <= 100_000


def take(docs: DataFrame, seed: int = 0, cycle: tuple[int, ...] = (1, 2, 3), repeats: int = MOST_REPEATS,
         shard_words: int = SHARD_WORDS, blocks_per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """One row per document: size, its source's size and target, and what the mix takes.

    ``taken`` counts words, repeats included; ``passes`` is how often the whole
    document is taken, ``spans`` the word ranges (from, to) taken once more. A
    document is never taken more than ``repeats`` times. NULL and empty texts
    have size 0 and nothing taken; a NULL source is a source of its own.
    Repeated rows are documents of their own: each row appears once, and rows
    that are equal lie in one shard in some order. Reruns give the same rows.
    """
    sized = stored(sizes(docs), "sizes")
    per_source = stored(targets(sized, cycle, repeats), "targets")
    quota = stored(quotas(sized, per_source, shard_words, blocks_per_shard), "quotas")
    placed = with_shard(sized, per_source, shard_words)
    known = quota.join(per_source.withColumnRenamed("source", "_t"), F.col("source").eqNullSafe(F.col("_t"))).drop("_t")
    known = known.withColumnsRenamed({"source": "_s", "shard": "_c"})
    cells = placed.join(known, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_c"))).drop("_s", "_c")
    # The stream of a shard: its documents in seeded order, cut every block_words words.
    cell = Window.partitionBy("source", "shard")
    stream = cell.orderBy(_draw("row_hash", seed=seed), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    # A shard is cut into equal blocks of about block_words words; its quota,
    # counted in blocks of block_words, is turned into words and then into its own blocks.
    blocks = F.greatest(F.lit(1), F.ceil(F.col("shard_size") / F.col("block_words")))
    own = F.round(F.col("quota") * F.col("block_words") * F.col("_blocks") / F.greatest(F.col("shard_size"), F.lit(1)))
    placed = cells.withColumns({"_end": F.sum("size").over(stream), "_blocks": blocks}).withColumns({
        "_start": F.col("_end") - F.col("size"),
        "_take": F.least(own.cast("long"), F.col("_blocks") * repeats),
    }).withColumns({
        "passes": F.floor(F.col("_take") / F.col("_blocks")),
        "_extra": F.pmod(F.col("_take"), F.col("_blocks")),
    })
    return placed.withColumn("_first", _draw("source", "shard", seed=seed)).withColumn(
        "spans", F.expr(_SPANS)
    ).withColumn(
        "taken", F.col("passes") * F.col("size") + F.expr("aggregate(spans, 0L, (a, s) -> a + s.upto - s.start)")
    ).select("doc_id", "source", "size", "source_size", "target", "taken", "passes", "spans", "row_hash")


# Word ranges of a document in the blocks taken once more: of its shard's
# _blocks equal blocks (block b from word floor(b * shard_size / _blocks) on),
# _extra ones from a drawn one on, cyclically.
_SPANS = """
transform(
  filter(
    if(size > 0, sequence(((_start + 1) * _blocks - 1) div shard_size, (_end * _blocks - 1) div shard_size),
       cast(array() as array<bigint>)),
    b -> pmod(b + _first, _blocks) < _extra
  ),
  b -> struct(greatest((b * shard_size) div _blocks, _start) - _start as start,
              least(((b + 1) * shard_size) div _blocks, _end) - _start as upto)
)
"""


@F.pandas_udf(StringType())
def word_range(text: pd.Series, start: pd.Series, upto: pd.Series) -> pd.Series:
    """The text from one word's first character to another's last."""
    def cut(t: str, a: int, b: int) -> str:
        places = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
        return t[places[a][0]:places[b - 1][1]]

    return pd.Series([cut(*row) for row in zip(text, start, upto)], dtype=object)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each pass over a
    document and one for each run of words taken once more, cut from its text.

    A document of no words is in no block, so it is not in the mix. Every
    column of ``docs`` comes back as it was, whatever its name; the texts of
    runs taken once more are cut.
    """
    chosen = take(docs, **options)
    runs = chosen.select("doc_id", "row_hash", "passes", "size", F.when(F.size("spans") > 0, F.col("spans")).alias("spans"))
    # neighbouring blocks of a document make one run: starts and ends that do not meet
    starts, ends = F.transform("spans", lambda s: s.start), F.transform("spans", lambda s: s.upto)
    cut = F.arrays_zip(
        F.array_sort(F.array_except(starts, ends)).alias("start"), F.array_sort(F.array_except(ends, starts)).alias("upto")
    )
    whole = F.when((F.col("passes") > 0) & (F.col("size") > 0), F.array_repeat(
        F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("upto")), F.col("passes").cast("int")
    ))
    none = F.expr("cast(array() as array<struct<start: bigint, upto: bigint>>)")
    pieces = runs.select(
        "doc_id", "row_hash", "size",
        F.explode(F.concat(F.coalesce(whole, none), F.coalesce(F.when(F.col("spans").isNotNull(), cut), none))).alias("piece"),
    ).withColumnsRenamed({"doc_id": "_d", "row_hash": "_h"})
    # rows that are equal in all columns are one here; their pieces are not. The
    # caller's columns are set aside under names of their own, so that none of
    # theirs (row_hash, size, piece, ...) is replaced or clashes.
    aside = {c: f"_in_{k}" for k, c in enumerate(docs.columns)}
    hidden = docs.withColumnsRenamed(aside)
    one = hidden.withColumn("_rh", F.xxhash64(*aside.values())).dropDuplicates([aside["doc_id"], "_rh"])
    joined = pieces.join(one, F.col(aside["doc_id"]).eqNullSafe(F.col("_d")) & (F.col("_rh") == F.col("_h")))
    parts = joined.filter(F.col("piece.upto") - F.col("piece.start") < F.col("size"))
    full = joined.filter(F.col("piece.upto") - F.col("piece.start") == F.col("size"))
    sliced = parts.withColumn(aside["text"], word_range(aside["text"], F.col("piece.start"), F.col("piece.upto")))
    back = [F.col(aside[c]).alias(c) for c in docs.columns]
    return full.select(*back).unionByName(sliced.select(*back))
