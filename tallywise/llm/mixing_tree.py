"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are dealt into blocks by hash, anew for each pass over
the source (a source may be taken twice, never more). The wanted words fix how
many blocks, in permuted order, each source gives: all blocks of its full
passes, then blocks of the next pass up to the one in which the target falls;
of that one, documents are taken in permuted order while they fit (see ``fitting``). The block
quotas of all sources are then split among the output shards down a binary
tree, each node drawing its left half's share from a multivariate
hypergeometric distribution; a shard gets the next blocks of each source's
permuted list, so shards are disjoint, and shuffles its documents locally by
hash.

Everything that grows with the documents stays in Spark. The driver sees one
row per source (its words and documents), and the tree holds one number per
source and shard. Blocks have about ``BLOCK`` documents at every size.

Defined cases: null texts have size 0; a null source is a source of its own,
the last; null ids are hashed by text and size alone; repeated rows are documents
of their own, numbered so that they fall into different blocks (which of several equal rows gets which
number is not defined); sources without words give nothing; empty input gives an empty
mix. Sources are few: one row each reaches the driver. Reruns give equal rows: all draws are hashes or seeded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.llm.common import fresh, pipeline_stage, stage

WEIGHTS = (3, 1, 2)    # by rank of the source, repeating
SHARE = 1.5            # words of the mix over words of all sources
PASSES = 2             # at most this often is a document taken
SHARDS = 64
BLOCK = 256            # documents to a block, about
SEED = 20260


def word_count(text) -> "F.Column":
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: list[int], share: float = SHARE, passes: int = PASSES) -> list[float]:
    """Words wanted of each source (in rank order): by weight, at most ``passes`` times its size,
    the excess going to the others by weight until none is above."""
    weights = [WEIGHTS[k % len(WEIGHTS)] for k in range(len(sizes))]
    total, capped = share * sum(sizes), set()
    while True:
        left = total - sum(passes * sizes[k] for k in capped)
        open_weight = sum(w for k, w in enumerate(weights) if k not in capped)
        want = [float(passes * n) if k in capped else left * weights[k] / open_weight for k, n in enumerate(sizes)]
        above = {k for k, n in enumerate(sizes) if k not in capped and want[k] > passes * n}
        if not above:
            return want
        capped |= above


def split_quotas(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of each source for each shard (shards x sources); columns sum to ``quotas``.

    Top down: a node with k shards gives its left k//2 shards their share of
    its blocks, drawn from the multivariate hypergeometric distribution."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def descend(have: np.ndarray, lo: int, hi: int, node: int) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid = (lo + hi) // 2
        total = int(have.sum())
        take = total * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, node])
        left = np.zeros_like(have)
        rest, want = total, take
        for k, n in enumerate(have):  # its marginals in turn
            rest -= int(n)
            left[k] = rng.hypergeometric(int(n), rest, want) if want else 0
            want -= int(left[k])
        descend(left, lo, mid, 2 * node)
        descend(have - left, mid, hi, 2 * node + 1)

    if len(quotas):
        descend(np.asarray(quotas, np.int64), 0, shards, 1)
    return out


def plan_mix(rows: DataFrame, draws_on: list[str], source: str, size: str, shards: int = SHARDS, seed: int = SEED,
             share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """The sources (source, rank, source_size, target, n_blocks) and the plan: one row per source
    and pass with its last block, what is left for it, and where its blocks go."""
    spark = rows.sparkSession
    # one row per source, the mix's control data
    totals = sorted(rows.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("n"), F.count(F.lit(1)).alias("docs")).collect(),
                    key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    wants = targets([r["n"] for r in totals], share)
    sources = stage(spark.createDataFrame(
        [(r["source"], k, int(r["n"]), float(w), max(1, -(-int(r["docs"]) // BLOCK))) for k, (r, w) in enumerate(zip(totals, wants))],
        T.StructType([T.StructField("s_source", rows.schema[source].dataType), T.StructField("rank", T.IntegerType()),
                      T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
                      T.StructField("n_blocks", T.IntegerType())])), "sources")
    want = F.greatest(F.lit(0.0), F.least(F.col("source_size").cast("double"), F.col("target") - F.col("pass") * F.col("source_size")))
    passes = (sources.withColumn("pass", F.explode(F.array(*[F.lit(p) for p in range(PASSES)])))
              .withColumn("want", want).where("want > 0"))
    dealt = deal(rows.select(*draws_on, source, size), passes, draws_on, source, seed)
    blocks = dealt.groupBy("rank", "pass", "block").agg(F.sum(size).alias("words"), F.first("want").alias("want"))
    # 1 row for BLOCK documents; blocks are drawn by hash, so their order is the permutation
    order = W.partitionBy("rank", "pass").orderBy("block")
    last = (blocks.withColumn("left", F.col("want") - F.sum("words").over(order) + F.col("words")).where("left > 0")
            .groupBy("rank", "pass").agg(F.max_by(F.struct("block", "left", "words"), "block").alias("x"))
            .select("rank", "pass", "x.*"))
    ends = sorted((r["rank"], r["pass"], r["block"]) for r in last.select("rank", "pass", "block").collect())  # a row per source and pass
    quotas, offset = {}, {}
    for rank, turn, block in ends:
        offset[rank, turn] = quotas.get(rank, 0)
        quotas[rank] = quotas.get(rank, 0) + block + 1
    ranks = sorted(quotas)
    table = split_quotas([quotas[k] for k in ranks], shards, seed)
    place = {k: [int(v) for v in np.cumsum(table[:, j])] for j, k in enumerate(ranks)}
    where = stage(spark.createDataFrame([(r, t, offset[r, t], place[r]) for r, t, _ in ends],
                                        "rank int, pass int, offset long, ends array<bigint>"), "ends")
    plan = passes.join(last, ["rank", "pass"]).join(where, ["rank", "pass"])
    return sources, stage(plan.select("s_source", "rank", "n_blocks", "pass", F.col("block").alias("last"), "left",
                                      (F.col("words") <= F.col("left")).alias("all"), "offset", "ends"), "plan")


def deal(rows: DataFrame, passes: DataFrame, draws_on: list[str], source: str, seed: int = SEED) -> DataFrame:
    """``rows`` once for each of its source's passes, with draw and block. A row's draws follow from the columns ``draws_on``."""
    draw = F.xxhash64(F.lit(seed), F.col("rank"), F.col("pass"), *[F.col(c) for c in draws_on])
    return (rows.join(passes, rows[source].eqNullSafe(passes["s_source"])).withColumn("draw", draw)
            .withColumn("block", F.pmod(F.xxhash64("draw", F.lit(seed)), F.col("n_blocks")).cast("int")))


def mix(rows: DataFrame, draws_on: list[str], source: str, size: str, key: str, shards: int = SHARDS,
        seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The rows that the mix takes, once for each time, and the sources.

    ``rows`` must read equal each time (they are read several times), ``key``
    unique. Returned rows have the new columns mix_shard and mix_place."""
    sources, plan = plan_mix(rows, draws_on, source, size, shards, seed)
    clash = {c: f"mix__{c}" for c in rows.columns}  # rows may have columns named like the plan's
    back = {v: k for k, v in clash.items()}
    own = rows.withColumnsRenamed(clash)
    c_source, c_size, c_key = (clash[c] for c in (source, size, key))
    shard = F.size(F.filter("ends", lambda e: e <= F.col("offset") + F.col("block")))
    taken = (deal(own, plan, [clash[c] for c in draws_on], c_source, seed).where(F.col("block") <= F.col("last"))
             .withColumn("mix_shard", shard).withColumn("mix_place", F.col("draw")))
    whole = F.col("all") | (F.col("block") < F.col("last"))
    # one block per source and pass at most
    fits = (taken.where(~whole).select("rank", F.col(c_key).alias("key"), "pass", "draw", F.col(c_size).alias("size"), "left")
            .repartition("rank").sortWithinPartitions("rank", "draw", "key")
            .mapInArrow(_fit, "fit_key long, fit_pass int"))
    part = taken.where(~whole).join(fits, (F.col(c_key) == F.col("fit_key")) & (F.col("pass") == F.col("fit_pass")))
    cols = [*back, "mix_shard", "mix_place"]
    return taken.where(whole).select(*cols).unionByName(part.select(*cols)).withColumnsRenamed(back), sources


def fitting(sizes: list[int], room: float) -> list[int]:
    """Places of the documents of a source's last block that the mix takes.

    In permuted order those that fit into what is left; then the one change that brings the mix nearest to its
    target, if any does: one more document, or one left out taken for one that was in (the first of equals)."""
    into, out = [], []
    for k, n in enumerate(sizes):
        if n <= room:
            into.append(k)
            room -= n
        else:
            out.append(k)
    if not out or room <= 0:
        return into
    without = np.array([0, *(sizes[k] for k in into)], float)
    off = np.abs(room - (np.array([sizes[k] for k in out], float)[:, None] - without))
    u, t = np.unravel_index(off.argmin(), off.shape)
    if off[u, t] < room:
        into = [k for k in into if not t or k != into[t - 1]] + [out[u]]
    return into


def _fit(batches):
    """The documents taken of each source's last block, which is about ``BLOCK`` documents."""
    rank, left, held = None, 0.0, []

    def out(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32())], ["fit_key", "fit_pass"])

    def close():
        return [held[k][1] for k in fitting([n for n, _ in held], left)]

    for batch in batches:
        keep = []
        for r, size, room, *row in zip(*(batch.column(c).to_pylist() for c in ("rank", "size", "left", "key", "pass"))):
            if r != rank:
                keep += close()
                rank, left, held = r, room, []
            held.append((size, row))
        yield out(keep)
    yield out(close())


def twins(rows: DataFrame, draws_on: list[str], key: str, part: str) -> DataFrame:
    """Numbers from 1 for the second and further ones of rows that are equal in ``draws_on``: twin_key, twin.

    A group's rows are numbered in each part of the written rows and the parts' counts added up before,
    so no task sees a whole group."""
    group = F.xxhash64(*draws_on)
    own = rows.select(F.col(key).alias("twin_key"), F.col(part).alias("part"), group.alias("twins"))
    counts = own.groupBy("twins", "part").agg(F.count("*").alias("n"))
    among = W.partitionBy("twins")
    offsets = (counts.withColumn("all", F.sum("n").over(among)).where(F.col("all") > 1)
               .withColumn("before", F.sum("n").over(among.orderBy("part")) - F.col("n")).select("twins", "part", "before"))
    many = own.join(offsets, ["twins", "part"])
    place = F.row_number().over(W.partitionBy("twins", "part").orderBy("twin_key"))
    return (many.select("twin_key", (F.col("before") + place - 1).cast("long").alias("twin")).where("twin > 0"))


def keyed_sizes(docs: DataFrame, columns: list[str], doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str, str, list[str]]:
    """``columns`` of the documents with a word count and a row number, fixed by being written, and the columns on
    which a row's draws depend: its id, size, the text's hash and its number among equal rows."""
    size, key, mark, part, twin = (fresh(docs, c) for c in ("size", "row", "mark", "part", "twin"))
    counted = docs.select(*columns, word_count(F.col(text)).alias(size), F.xxhash64(text).alias(mark))
    rows = stage(counted.withColumn(key, F.monotonically_increasing_id()).withColumn(part, F.spark_partition_id()), "sized")
    numbers = stage(twins(rows, [doc_id, size, mark], key, part), "twins")
    if numbers.isEmpty():
        return rows.drop(part).withColumn(twin, F.lit(0).cast("long")), size, key, [doc_id, size, mark, twin]
    numbers = numbers.withColumnsRenamed({"twin_key": f"{key}_of_twin", "twin": twin})
    numbered = (rows.drop(part).join(numbers, F.col(key) == F.col(f"{key}_of_twin"), "left").drop(f"{key}_of_twin")
                .withColumn(twin, F.coalesce(twin, F.lit(0).cast("long"))))
    return numbered, size, key, [doc_id, size, mark, twin]


def mix_sizes(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken for every document, and the output shards that took it:
    ``shards`` and the places in them, by shard, joined by commas. A document is taken as often as shards drew it."""
    rows, size, key, draws_on = keyed_sizes(docs, ["doc_id", "source"])
    taken, sources = mix(rows, draws_on, "source", size, key, shards, seed)
    drawn = (taken.groupBy(F.col(key).alias("drawn_key"))
             .agg(F.sort_array(F.collect_list(F.struct("mix_shard", "mix_place"))).alias("drawn")))  # PASSES entries at most
    return (rows.join(drawn, rows[key] == drawn["drawn_key"], "left")
            .join(sources, rows["source"].eqNullSafe(sources["s_source"]))
            .select("doc_id", F.col(size).alias("size"), "source_size", "target",
                    (F.col(size) * F.coalesce(F.size("drawn"), F.lit(0))).cast("long").alias("taken"),
                    F.coalesce(F.array_join(F.col("drawn.mix_shard").cast("array<string>"), ","), F.lit("")).alias("shards"),
                    F.coalesce(F.array_join(F.col("drawn.mix_place").cast("array<string>"), ","), F.lit("")).alias("places")))


@pipeline_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mix itself, a row for each time a document is taken, shard by shard."""
    rows, size, key, draws_on = keyed_sizes(docs, docs.columns)
    taken, _ = mix(rows, draws_on, "source", size, key)
    return (taken.repartition(SHARDS, "mix_shard").sortWithinPartitions("mix_shard", "mix_place", key).select(*docs.columns))
