"""Sharding through a hierarchical weighted hash tree of regions, racks and shards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlode.llm.totals import bucket_count, running_totals, unit_hash
from ledgerlode.sources.files import stored


@dataclass(frozen=True)
class Node:
    """A leaf holds its shard number and weight; an inner node its children."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int = -1
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def shard_tree(shards: int = 8, racks: int = 2, per_rack: int = 2) -> Node:
    """Regions of ``racks`` racks of ``per_rack`` shards, the last ones filled as far as it goes."""
    leaves = [Node(f"shard-{i}", shard=i) for i in range(shards)]
    rack_nodes = [Node(f"rack-{i}", tuple(leaves[i * per_rack:(i + 1) * per_rack]))
                  for i in range(-(-shards // per_rack))]
    regions = [Node(f"region-{i}", tuple(rack_nodes[i * racks:(i + 1) * racks]))
               for i in range(-(-len(rack_nodes) // racks))]
    return Node("root", tuple(regions))


def grown(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region of its own. Where it hangs does not change any other shard's draw,
    so this is the tree of one shard more as far as rows go."""
    leaf = Node(f"shard-{shard}", shard=shard, own_weight=weight)
    return Node(tree.name, (*tree.children, Node(f"grown-region-{shard}", (Node(f"grown-rack-{shard}", (leaf,)),))))


def _draw(key: Column, node: Node) -> Column:
    """The smallest draw below a node and its shard. A shard draws -ln(u) / weight, where u is a hash of the key and
    the shard's name; the smallest draw of several shards is distributed as one draw by the sum of their weights, so
    every node draws by its weight, and a shard that comes, goes or changes its weight moves only rows that it
    wins or loses."""
    if not node.children:
        return F.struct((-F.log(unit_hash(key, F.lit(node.name))) / F.lit(node.weight)).alias("draw"),
                        F.lit(node.shard).alias("shard"))
    draws = [_draw(key, child) for child in node.children]
    return draws[0] if len(draws) == 1 else F.least(*draws)


def descend(key: Column, node: Node) -> Column:
    """The shard number of a key: from the root down, always the child with the smallest draw."""
    return _draw(key, node)["shard"]


def shard_documents(documents: DataFrame, tree: Node | None = None, shards: int = 8,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each document, after the columns
    ``carry``.

    The law is ``key``: the id and the tree alone decide the shard, and the trees of all numbers of shards agree: one
    shard more takes rows into itself only, and ``grown_shard`` is the shard that that number gives. ``slot`` numbers
    the rows of a shard from 0 without gaps, in the order of a hash of id and text checksum.

    A null text has size 1 and checksum 0. Null ids are one key, and rows with the same id share a shard
    and have slots of their own. Other columns are ignored. Empty tables give no rows. No task holds a
    whole shard (``running_totals``).
    """
    tree = tree or shard_tree(shards)
    more = grown(tree, shards)
    content = F.coalesce(F.col("text"), F.lit(""))
    ready = documents.select(
        *carry, *(["doc_id"] if "doc_id" not in carry else []),
        (F.octet_length(content) + F.lit(1)).cast("long").alias("__size"),
        F.crc32(content.cast("binary")).cast("long").alias("__crc"),
        descend(F.col("doc_id"), tree).cast("int").alias("__shard"),
        descend(F.col("doc_id"), more).cast("int").alias("__grown"))
    ready = stored(ready.withColumn("__unit", unit_hash(F.col("doc_id"), F.col("__crc")))
                        .withColumn("__one", F.lit(1)), "shard-rows")
    counts = stored(ready.groupBy(F.col("__shard").alias("__of"))
                         .agg(bucket_count(F.count(F.lit(1))).alias("__buckets")), "shard-counts")
    placed = ready.join(counts, F.col("__shard") == F.col("__of"))
    numbered = running_totals(placed, "__shard", "__buckets", "__unit",
                              ["__unit", "doc_id", "__crc", "__size"], "__one", "__slot")
    own = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    values = {"doc_id": F.col("doc_id"), "size": F.col("__size"), "text_crc32": F.col("__crc"),
              "law": F.lit("key"), "shard": F.col("__shard"), "slot": F.col("__slot").cast("long"),
              "grown_shard": F.col("__grown")}
    return numbered.select(*[c for c in carry if c not in own], *[values[c].alias(c) for c in own])
