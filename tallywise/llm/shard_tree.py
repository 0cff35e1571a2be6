"""Sharding by a hierarchical weighted hash tree.

Shards hang below racks and racks below regions; a node's weight is the sum of
its shards' weights. A document descends from the root: at each level every
child draws ``-ln(u) / weight`` with ``u`` hashed from the document's id and
the child's identity, and the smallest draw wins. A child's draws do not
depend on its siblings, so when a weight changes, documents move only into or
out of the subtrees whose weights changed, and below an unchanged path nothing
moves. A shard that is added as a rack and region of its own takes rows only
into itself (law ``key``).

Everything is DataFrame expressions. Rows that are equal in all placed columns
are counted before they are numbered, so a hot id costs one row; slots are
numbered within fine hash buckets and offset by bucket counts, of which there
are ``BUCKETS`` for a shard; buckets are drawn from id and text, so the texts of
a hot id spread. Counted rows come back in pieces of ``PIECE`` copies, dealt to
all tasks.

Defined cases: a null id draws as the value its hash has; null texts have size
16 and the checksum of no bytes; repeated rows share a shard and get slots of
their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARDS = 40
RACK = 5          # shards in a rack
REGION = 4        # racks in a region
BUCKETS = 512
PIECE = 4096      # copies of a row that one array brings back
OVERHEAD = 16     # bytes of a document besides its text
SEED = 97

Tree = list[list[list[float]]]  # regions of racks of shard weights


def even_tree(shards: int, weight: float = 1.0) -> Tree:
    """Shards in order, RACK to a rack and REGION racks to a region; the last ones may be short."""
    racks = [[weight] * min(RACK, shards - a) for a in range(0, shards, RACK)]
    return [racks[a:a + REGION] for a in range(0, len(racks), REGION)]


def with_new_region(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree and one more shard, in a region of its own."""
    return [*tree, [[weight]]]


def uniform(key: Column, *path) -> Column:
    """A number in (0, 1) hashed from the document and a child's place in the tree."""
    h = F.xxhash64(F.lit(SEED).cast("long"), key, *[p if isinstance(p, Column) else F.lit(p).cast("long") for p in path])
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) * (2.0 ** -53)


def pick(key: Column, weights: list[float], *path: int) -> Column:
    """The index of the child with the smallest draw; children without weight never win."""
    draws = [F.struct((-F.log(uniform(key, *path, k)) / w).alias("draw"), F.lit(k).alias("child"))
             for k, w in enumerate(weights) if w > 0]
    return (F.least(*draws) if len(draws) > 1 else draws[0]).getField("child")


def place(tree: Tree, key: Column) -> Column:
    """The shard's number, counted through the tree in order."""
    first, number = {}, 0
    for r, racks in enumerate(tree):
        for k, shards in enumerate(racks):
            first[r, k], number = number, number + len(shards)
    region = pick(key, [sum(map(sum, racks)) for racks in tree], 0)
    out = None
    for r, racks in enumerate(tree):
        if sum(map(sum, racks)) <= 0:
            continue
        rack, within = pick(key, [sum(s) for s in racks], 1, r), None
        for k, shards in enumerate(racks):
            if sum(shards) <= 0:
                continue
            shard = pick(key, shards, 2, r, k) + F.lit(first[r, k])
            within = F.when(rack == k, shard) if within is None else within.when(rack == k, shard)
        out = F.when(region == r, within) if out is None else out.when(region == r, within)
    return out.cast("int")


def shard_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    tree = even_tree(shards)
    content = F.coalesce(F.col(text), F.lit(""))
    key = F.col("doc_id")
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(content) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(content).alias("text_crc32"))
    rows = (rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(SEED + 1)), F.lit(BUCKETS)).cast("int"))
            .withColumn("shard", place(tree, key))
            .withColumn("grown_shard", place(with_new_region(tree), key)))
    order = W.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    rows = rows.withColumn("before", F.sum("copies").over(order) - F.col("copies"))
    # shards x BUCKETS rows at most, a proven bound for the broadcast and the window
    sizes = rows.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
    upto = W.partitionBy("shard").orderBy("bucket")
    sizes = sizes.select(F.col("shard").alias("b_shard"), F.col("bucket").alias("b_bucket"),
                         (F.sum("n").over(upto) - F.col("n")).alias("offset"))
    placed = rows.join(F.broadcast(sizes), (F.col("shard") == F.col("b_shard")) & (F.col("bucket") == F.col("b_bucket")))
    last = F.floor((F.col("copies") - 1) / PIECE).cast("long")
    pieces = (placed.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
              .repartition("shard", "bucket", "before", "piece"))
    own = F.sequence(F.col("piece") * PIECE, F.least(F.col("copies"), (F.col("piece") + 1) * PIECE) - 1)
    return (pieces.withColumn("copy", F.explode(own))
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.col("before") + F.col("copy")).cast("long").alias("slot"), "grown_shard"))
