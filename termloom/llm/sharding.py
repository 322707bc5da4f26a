"""Shards by a hierarchical weighted hash tree.

A tree has regions of racks of shards, each shard with a weight; a rack weighs what
its shards weigh together, a region what its racks weigh. A document descends level
by level: at each node every child draws a hash of the document's id and the child's
name, the draw counts the more the heavier the child, and the best one wins. As a
draw depends on nothing but the id, the child and the child's weight,

* a document's shard follows from its id and the tree alone;
* a changed weight moves documents only into or out of the nodes on the way to it,
  and leaves the choices within all other subtrees as they are;
* a new shard in a region of its own (``grown``) takes documents only into itself.

Defined results: rows without id all go to one shard, rows that repeat an id to the
same one; a null text counts as an empty one; equal rows have slots of their own. A
column that has the name of an added one, in any case, is replaced. No rows, no slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import column, saved, without

# Region -> rack -> shard -> weight.
Tree = dict[str, dict[str, dict[int, float]]]
# A hash's upper bits that a double holds exactly.
_BITS = 53


def balanced(shards: int, per_rack: int = 4, racks: int = 2) -> Tree:
    """Shards 0, 1, ... of weight 1, dealt in order to racks and these to regions."""
    tree: Tree = {}
    for shard in range(shards):
        rack = shard // per_rack
        tree.setdefault(f"region{rack // racks}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    return tree


def shards_of(tree: Tree) -> list[int]:
    return sorted(s for racks in tree.values() for shards in racks.values() for s in shards)


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """``tree`` with one more shard, in a region of its own."""
    shard = shards_of(tree)[-1] + 1
    return {**tree, f"region of {shard}": {f"rack of {shard}": {shard: weight}}}


def reweighted(tree: Tree, shard: int, weight: float) -> Tree:
    """``tree`` with another weight for one shard."""
    return {
        region: {
            rack: {s: weight if s == shard else w for s, w in shards.items()}
            for rack, shards in racks.items()
        }
        for region, racks in tree.items()
    }


def _check(tree: Tree) -> None:
    weights = [w for racks in tree.values() for shards in racks.values() for w in shards.values()]
    shards = shards_of(tree)
    if not weights or min(weights) <= 0 or len(set(shards)) < len(shards):
        raise ValueError("a tree has shards of different numbers and positive weights")
    if not all(tree.values()) or not all(s for racks in tree.values() for s in racks.values()):
        raise ValueError("a region has racks, and a rack has shards")


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: Column, name: str, weight: float) -> Column:
    """Exponentially distributed with rate ``weight``: the least of some wins by its weight's share."""
    hashed = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 64 - _BITS)
    share = (hashed.cast("double") + F.lit(0.5)) / F.lit(float(1 << _BITS))
    return -F.ln(share) / F.lit(weight)


def _winner(key: Column, level: str, children: dict) -> Column:
    """Place, among ``children``, of the child that wins the document."""
    if len(children) == 1:
        return F.lit(0)
    draws = [
        F.struct(_draw(key, f"{level}:{name}", _weight(node)).alias("draw"), F.lit(k).alias("child"))
        for k, (name, node) in enumerate(children.items())
    ]
    return F.least(*draws)["child"]


def _by_case(choice: Column, values: list[Column]) -> Column:
    """The value at the place that ``choice`` names; only that one is computed."""
    if len(values) == 1:
        return values[0]
    found = F.when(choice == 0, values[0])
    for k, value in enumerate(values[1:-1], 1):
        found = found.when(choice == k, value)
    return found.otherwise(values[-1])


def placed(docs: DataFrame, tree: Tree, prefix: str = "", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``region, rack, shard`` (names with ``prefix`` before); nothing is shuffled."""
    _check(tree)
    region, rack, shard = f"{prefix}region", f"{prefix}rack", f"{prefix}shard"
    own = column(key)
    regions = list(tree.values())
    at_region = F.col("_at_region")
    marked = without(docs, [region, rack, shard, "_at_region", "_at_rack", "_at_shard"])
    marked = marked.withColumn("_at_region", _winner(own, "region", tree))
    marked = marked.withColumn(
        "_at_rack", _by_case(at_region, [_winner(own, "rack", racks) for racks in regions])
    )

    def each(of_rack) -> Column:
        """Of the rack that was chosen."""
        per_region = [
            _by_case(F.col("_at_rack"), [of_rack(name, shards) for name, shards in racks.items()])
            for racks in regions
        ]
        return _by_case(at_region, per_region)

    marked = marked.withColumn(
        shard,
        each(
            lambda _, shards: _by_case(
                _winner(own, "shard", shards), [F.lit(s).cast("int") for s in shards]
            )
        ),
    )
    return (
        marked.withColumn(region, _by_case(at_region, [F.lit(name) for name in tree]))
        .withColumn(rack, each(lambda name, _: F.lit(name)))
        .drop("_at_region", "_at_rack")
    )


def text_size(text: Column) -> Column:
    """Bytes in UTF-8 and one more, as for an end mark; a null text has none of its own."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("bigint")


def with_slots(rows: DataFrame, shard: str = "shard", lanes: int | None = None) -> DataFrame:
    """``rows`` with ``slot``: each shard's rows numbered from 0 without gaps.

    Rows are dealt to lanes of their shard by a hash of all their columns. A lane's
    first slot is the number of rows in the lanes before it, a small table, and
    within a lane rows are numbered in order; so no task sees a whole shard, however
    few shards there are. Rows equal in every column are counted before the shuffle
    and get their slots at the end. ``rows`` should have narrow columns that can be
    compared; they are written to the shared folder when this is called. Lanes are as
    many as shuffle partitions, unless stated.
    """
    if lanes is None:
        lanes = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = without(rows, ["slot", "_lane", "_n", "_start"])
    names = [column(c) for c in rows.columns]
    own = column(shard)
    # Read twice below; what the rows were made of is read once.
    dealt = saved(rows.withColumn("_lane", F.pmod(F.xxhash64(*names), F.lit(lanes)).cast("int")))
    sums = dealt.groupBy(own, "_lane").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(own).orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(own, "_lane", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    counted = dealt.groupBy(*names, "_lane").agg(F.count("*").alias("_n"))
    within = Window.partitionBy(own, "_lane").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum("_n").over(within), F.lit(0))
    started = counted.join(starts, [shard, "_lane"]).select(*names, "_n", before.alias("_start"))
    slots = F.sequence(F.col("_start"), F.col("_start") + F.col("_n") - 1)
    return started.select(*names, F.explode(slots).alias("slot"))


def shard_rows(docs: DataFrame, tree: Tree, larger: Tree | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for each row of ``docs``.

    ``grown_shard`` is the shard under ``larger``, the tree with one more shard unless
    stated. ``text_crc32`` is of the text's bytes, 0 for none.
    """
    larger = larger if larger is not None else grown(tree)
    narrow = docs.select(
        "doc_id",
        text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("text_crc32"),
    )
    both = placed(placed(narrow, tree), larger, "grown_")
    slots = with_slots(both.select("doc_id", "size", "text_crc32", "shard", "grown_shard"))
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def write_shards(docs: DataFrame, path: str, tree: Tree, files: int = 1) -> None:
    """Write ``docs`` as Parquet, a folder for each shard, of ``files`` files at most.

    A shard's rows are dealt over its files by a hash of id and text, so that none
    of them is written by one task alone.
    """
    rows = placed(docs, tree).drop("region", "rack")
    lane = F.pmod(F.xxhash64("doc_id", "text"), F.lit(files))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(tasks, "shard", lane).write.partitionBy("shard").parquet(path)
