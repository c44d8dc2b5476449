"""A Merkle manifest of a dataset, built level by level with lag and lead windows.

Every row is a leaf: the digest of its fields. Within a group (a source) the
leaves ascend by ``doc_id``; every ``FANOUT`` consecutive nodes become the
digest of their concatenated digests, level after level, until one node, the
group's subroot, remains. The subroots, ordered by group, give the root the
same way.

How it runs on Spark:

* The place of a row in its group comes from a range-partitioned sort: each
  task numbers its rows, and per (task, group) counts, a table bounded by the
  number of tasks plus groups, give each run its offset. A group that holds a
  third of all rows is spread over many tasks.
* A level is one window over (group, parent): on the first child of each
  parent, fixed-offset ``lead`` columns, cut off where the run ends, give the
  digests of all children; the parent keeps them as one string and is their
  digest. A node's siblings are the parts of that string before and after its
  slot. Window partitions hold at most ``FANOUT`` rows.
* Proofs are carried down from the root: a parent's path is its own siblings
  followed by its parent's path. Each parent meets at most ``FANOUT`` children,
  so no join key is hot. The paths stop at the parents of leaves, where each
  row gives the results of its children: no leaf carries a path.
* Every level is written to the shared folder, so a lost executor costs only
  its tasks, and plans are made on measured sizes.

Defined cases: NULL fields are written ``-`` in the leaf; a NULL ``doc_id``
sorts first and a NULL group is a group of its own, ordered first; repeated
rows are separate leaves and, being equal, get equal results; a lone leaf is its
group's subroot, a lone subroot the root; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearyard.llm.common import crc_remainder, stored

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return digest(*(field(c) for c in (doc_id, source, lang, n_chars, text)))


def lower_ascii(text: Column) -> Column:
    """Text with A-Z lower-cased and every other character as it was."""
    return F.translate(text, _UPPER, _UPPER.lower())


def _ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds ``_idx``, the 0-based place of each row within its ``_g`` by ``order``,
    and ``_size``, the number of rows of its group."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = [F.col("_g").asc_nulls_first(), *order]
    local = (
        rows.repartitionByRange(parts, *key)
        .sortWithinPartitions(*key)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id())
    )
    local = stored(local, "merkle-rank")
    runs = local.groupBy("_part", "_g").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_g")
    runs = runs.select(
        F.col("_part").alias("_rp"),
        F.col("_g").alias("_rg"),
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_size"),
    )
    joined = local.join(runs, (F.col("_part") == F.col("_rp")) & F.col("_g").eqNullSafe(F.col("_rg")))
    return joined.withColumn("_idx", F.col("_id") - F.col("_first") + F.col("_before")).drop(
        "_rp", "_rg", "_first", "_before", "_id", "_part"
    )


def _levels(nodes: DataFrame, label: str, tampered: bool = False) -> tuple[list[DataFrame], DataFrame]:
    """Folds nodes (``_g``, ``_idx``, ``_h``, ``_size``, and ``_t`` if ``tampered``)
    to one per group.

    Returns, level by level, the parents: (``_g``, ``_idx``, ``_children``: the
    concatenated digests of its children, ``_size``: nodes of its group at its
    level, and ``_tchildren`` from ``_t`` at the first level if ``tampered``); and
    the tops: (``_g``, ``_h``, ``_depth``), one per group.
    """
    largest = nodes.agg(F.max("_size")).first()[0] or 1
    depth, size = 0, largest
    while size > 1:
        size, depth = -(-size // FANOUT), depth + 1
    run = Window.partitionBy("_g", "_parent").orderBy("_idx")

    def joined(column: str) -> Column:
        return F.concat(F.col(column), F.concat_ws("", *(F.lead(column, j).over(run) for j in range(1, FANOUT))))

    parents, tops = [], []
    for k in range(depth + 1):
        tops.append(nodes.filter("_size = 1").select("_g", "_h", F.lit(k).alias("_depth")))
        if k == depth:
            break
        active = nodes.filter("_size > 1").withColumn("_parent", F.floor(F.col("_idx") / FANOUT))
        extra = [joined("_t").alias("_tchildren")] if tampered and k == 0 else []
        level = active.select(
            "_g", "_idx", "_parent", joined("_h").alias("_children"), F.ceil(F.col("_size") / FANOUT).alias("_up"), *extra
        ).filter(F.col("_idx") % FANOUT == 0)
        level = stored(
            level.select("_g", F.col("_parent").alias("_idx"), "_children", F.col("_up").alias("_size"), *[e for e in ("_tchildren",) if extra]),
            f"merkle-{label}-{k}",
        )
        parents.append(level)
        nodes = level.select("_g", "_idx", digest(F.col("_children")).alias("_h"), "_size")
    top = tops[0]
    for more in tops[1:]:
        top = top.unionByName(more)
    return parents, stored(top, f"merkle-{label}-tops")


def _sides(children: Column, slot: Column) -> Column:
    """(left, right): the digests before and after the child at ``slot``."""
    width = 64
    return F.struct(
        F.substring(children, F.lit(1), slot * width).alias("left"),
        F.substring(children, (slot + 1) * width + 1, F.lit(1 << 30)).alias("right"),
    )


def _paths_down(parents: list[DataFrame], tops: DataFrame) -> DataFrame | None:
    """The first level's parents with ``_path``: the (left, right) siblings of the
    parent, level by level upwards, ending with its group top's ``_path``."""
    above = None
    for k in range(len(parents) - 1, -1, -1):
        rows = parents[k]
        ending = rows.filter("_size = 1").join(
            tops.select(F.col("_g").alias("_tg"), "_path"), F.col("_g").eqNullSafe(F.col("_tg"))
        ).drop("_tg")
        if above is not None:
            up = above.select(
                F.col("_g").alias("_ag"), F.col("_idx").alias("_ai"),
                F.col("_children").alias("_ac"), F.col("_path").alias("_ap"),
            )
            inner = rows.filter("_size > 1").join(
                up, F.col("_g").eqNullSafe(F.col("_ag")) & (F.floor(F.col("_idx") / FANOUT) == F.col("_ai"))
            )
            step = F.array(_sides(F.col("_ac"), F.col("_idx") % FANOUT))
            ending = ending.unionByName(
                inner.withColumn("_path", F.concat(step, F.col("_ap"))).drop("_ag", "_ai", "_ac", "_ap")
            )
        above = stored(ending, f"merkle-path-{k}")
    return above


def _top_paths(parents: list[DataFrame], tops: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` (level 0 of a tree, ``_g``, ``_idx``) with ``_path`` up to the
    top of their group, whose own path ``tops`` gives."""
    lone = nodes.join(tops.filter("_depth = 0").select(F.col("_g").alias("_tg"), "_path"), F.col("_g").eqNullSafe(F.col("_tg"))).drop("_tg")
    first = _paths_down(parents, tops)
    if first is None:
        return lone
    up = first.select(F.col("_g").alias("_ag"), F.col("_idx").alias("_ai"), F.col("_children").alias("_ac"), F.col("_path").alias("_ap"))
    inner = nodes.join(up, F.col("_g").eqNullSafe(F.col("_ag")) & (F.floor(F.col("_idx") / FANOUT) == F.col("_ai")))
    step = F.array(_sides(F.col("_ac"), F.col("_idx") % FANOUT))
    return lone.unionByName(inner.withColumn("_path", F.concat(step, F.col("_ap"))).drop("_ag", "_ai", "_ac", "_ap"))


def _proof(path: Column, left: Column, right: Column) -> Column:
    return F.sha2(F.concat(left, right, F.aggregate(path, F.lit(""), lambda acc, x: F.concat(acc, x["left"], x["right"]))), 256)


def _fold(path: Column, start: Column) -> Column:
    return F.aggregate(path, start, lambda acc, x: digest(x["left"], acc, x["right"]))


def manifest(docs: DataFrame, tamper: Column | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``source``, ``leaf``, ``subroot``,
    ``root``, ``proof_sha256`` (digest of all siblings, level by level up to the
    root, left to right), ``folded_root``: the root folded up from the leaf of
    the row, with its text's A-Z lower-cased where ``tamper`` (a boolean over the
    input) holds, and the original siblings; ``verified``: it equals ``root``.

    Reads the columns named in ``FIELDS``; other columns are left out. Proofs
    are made where the parents of leaves are: each of those rows gives the
    results of its children, so no leaf carries the path of its ancestors.
    """
    tamper = F.lit(False) if tamper is None else tamper
    rows = docs.select(
        F.col("doc_id").alias("_doc"),
        F.col("source").alias("_g"),
        leaf(*(F.col(c) for c in FIELDS)).alias("_h"),
        F.when(F.coalesce(tamper, F.lit(False)), leaf(*(F.col(c) for c in FIELDS[:4]), lower_ascii(F.col("text"))))
        .otherwise(leaf(*(F.col(c) for c in FIELDS)))
        .alias("_t"),
    )
    leaves = _ranked(rows, [F.col("_doc").asc_nulls_first(), F.col("_h")])
    parents, subroots = _levels(leaves.select("_g", "_idx", "_h", "_size", "_t"), "source", tampered=True)

    upper = _ranked(
        subroots.select(F.col("_g").alias("_source"), "_h", "_depth").withColumn("_g", F.lit(0)),
        [F.col("_source").asc_nulls_first()],
    )
    upper_parents, top = _levels(upper.select("_g", "_idx", "_h", "_size"), "root")
    root = top.select("_h").first()
    if root is None:
        empty = "doc_id {0}, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.sparkSession.createDataFrame([], empty.format(docs.schema["doc_id"].dataType.simpleString()))
    root = F.lit(root[0])

    no_path = F.array().cast("array<struct<left:string,right:string>>")
    upper_paths = _top_paths(upper_parents, top.withColumn("_path", no_path), upper.select("_g", "_idx", "_source", "_h", "_depth"))
    source_tops = stored(
        upper_paths.select(F.col("_source").alias("_g"), F.col("_h").alias("_subroot"), "_depth", "_path"),
        "merkle-subroots",
    )

    # Leaves that are their group's subroot, then the children of every first-level parent.
    results = leaves.filter("_size = 1").join(
        source_tops.select(F.col("_g").alias("_sg"), "_path"), F.col("_g").eqNullSafe(F.col("_sg"))
    ).select("_g", "_idx", _proof(F.col("_path"), F.lit(""), F.lit("")).alias("proof_sha256"), _fold(F.col("_path"), F.col("_t")).alias("folded_root"))
    first = _paths_down(parents, source_tops)
    if first is not None:
        slots = F.sequence(F.lit(0), (F.length("_children") / 64).cast("int") - 1)
        each = first.select("_g", "_idx", "_children", "_tchildren", "_path", F.explode(slots).alias("_slot"))
        sides = _sides(F.col("_children"), F.col("_slot"))
        own_t = F.substring(F.col("_tchildren"), F.col("_slot") * 64 + 1, F.lit(64))
        results = results.unionByName(each.select(
            "_g",
            (F.col("_idx") * FANOUT + F.col("_slot")).alias("_idx"),
            _proof(F.col("_path"), sides["left"], sides["right"]).alias("proof_sha256"),
            _fold(F.col("_path"), digest(sides["left"], own_t, sides["right"])).alias("folded_root"),
        ))
    results = results.select(F.col("_g").alias("_rg"), F.col("_idx").alias("_ri"), "proof_sha256", "folded_root")
    told = leaves.join(results, F.col("_g").eqNullSafe(F.col("_rg")) & (F.col("_idx") == F.col("_ri"))).join(
        source_tops.select(F.col("_g").alias("_sg"), "_subroot"), F.col("_g").eqNullSafe(F.col("_sg"))
    )
    return told.select(
        F.col("_doc").alias("doc_id"),
        F.col("_g").alias("source"),
        F.col("_h").alias("leaf"),
        F.col("_subroot").alias("subroot"),
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def tampered(doc_id: Column) -> Column:
    """Rows whose unsigned crc32 of the decimal id is divisible by 5 (a NULL id
    counts as empty text, whose crc32 is 0)."""
    return crc_remainder(doc_id, 5) == 0
