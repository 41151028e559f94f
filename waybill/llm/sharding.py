"""Sharding by a hierarchical weighted hash tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.common import numbered
from waybill.sources.sinks import scratch_folder, staged

#: region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]
SHARDS = 24
REGIONS, RACKS = 2, 3


def even_tree(shards: int = SHARDS, regions: int = REGIONS, racks: int = RACKS) -> Tree:
    """Equal shards in equal racks of equal regions; the counts must divide."""
    per_rack, odd = divmod(shards, regions * racks)
    if odd or not per_rack:
        raise ValueError(f"{shards} shards do not fill {regions} regions of {racks} racks")
    return {
        f"region-{r}": {
            f"rack-{r}-{k}": {(r * racks + k) * per_rack + s: 1.0 for s in range(per_rack)} for k in range(racks)
        }
        for r in range(regions)
    }


def grown_tree(tree: Tree) -> Tree:
    """With one more shard of weight 1 in a region of its own: no other weight changes, so
    whatever moves, moves into the new shard."""
    new = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return {**tree, f"region-of-{new}": {f"rack-of-{new}": {new: 1.0}}}


def descend(key: Column, tree: Tree) -> Column:
    """The shard of a key: at each level the child of the least weighted draw.

    A child's draw is exponential with its weight as rate and depends on the key and the
    child alone, so a change of weights moves keys only into subtrees that gain weight
    against their siblings and out of those that lose it. A region's or rack's weight is
    the sum of its shards'. Children without weight are never drawn.
    """
    racks = {r: {k: sum(s.values()) for k, s in inner.items()} for r, inner in tree.items()}
    regions = {r: sum(w.values()) for r, w in racks.items()}
    shards = {k: {str(s): w for s, w in inner.items()} for x in tree.values() for k, inner in x.items()}
    region = _drawn(key, "region", _children(regions))
    rack = _drawn(key, "rack", _of(region, racks))
    return _drawn(key, "shard", _of(rack, shards)).cast("int")


def _children(weights: dict[str, float]) -> Column:
    some = [(n, w) for n, w in weights.items() if w > 0]
    return F.array(*(F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in some))


def _of(parent: Column, children: dict[str, dict[str, float]]) -> Column:
    pairs = [c for p, inner in children.items() if sum(inner.values()) > 0 for c in (F.lit(p), _children(inner))]
    return F.element_at(F.create_map(*pairs), parent)


def _drawn(key: Column, level: str, children: Column) -> Column:
    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), child["name"]), 11)
        uniform = (bits.cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.ln(uniform) / child["weight"]).alias("draw"), child["name"].alias("name"))

    return F.array_min(F.transform(children, draw))["name"]


def shard(docs: DataFrame, tree: Tree, grown: Tree | None = None, *, scratch: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot[, grown_shard]) per row of ``docs``.

    The shard follows from the id and the tree alone. ``size`` is the text's UTF-8 bytes and
    8 more; ``slot`` counts a shard's rows from 0 in the order of their ids. A null text has
    no bytes and checksum 0, as an empty one; null ids all get the same shard, as do rows
    that repeat an id, each with a slot of its own. An empty table gives no rows.
    """
    scratch = scratch or scratch_folder(docs.sparkSession)
    text = F.coalesce("text", F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    columns = ["doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")]
    columns.append(descend(key, tree).alias("shard"))
    if grown:
        columns.append(descend(key, grown).alias("grown_shard"))
    placed = staged(docs.select(*columns), scratch, "sharded")
    return numbered(placed, ["shard"], ["doc_id", "size", "text_crc32"], scratch, "by-shard").withColumnRenamed(
        "rank", "slot"
    )


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    tree = even_tree()
    found = shard(docs, tree, grown_tree(tree))
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
