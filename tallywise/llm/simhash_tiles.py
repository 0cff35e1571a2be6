"""SimHash near-dedup by tiled exact comparison.

Fingerprints are 64-bit majority votes over the XXH64 hashes of 3-word
shingles. Distinct fingerprints are put into tiles by the population counts
of their four 16-bit quarters. Two fingerprints at most ``RADIUS`` bits apart
have quarter counts whose differences sum to at most ``RADIUS``, so a pair of
tiles further apart is skipped; every other pair is compared in full with
numpy exclusive-or and bit counts. A tile pair yields a spanning forest of its
links (no link between components is lost, no group emits all its pairs), and
components are contracted by Spark joins.

Bounds: there are at most 17^4 tiles; a tile is cut into chunks of about
``CHUNK`` fingerprints, so the unit of work stays small however many
fingerprints share a tile. Copies share one fingerprint and meet only as one
row.

Defined cases: null, empty and wordless texts have fingerprint zero and link
like any other; rows with a null id belong to their component but are no
candidates for its id (a component without ids has id null); repeated rows
are copies; empty input gives empty output.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.llm.common import fresh, pipeline_stage, stage, with_text_columns

SHINGLE = 3
RADIUS = 3
SEED = 42
CHUNK = 1024          # fingerprints to a chunk, about
QUARTERS = 4
FIELD = 6             # bits for a quarter's count in a tile's code
PIECE = 1 << 16       # shingles voted on at once
BLOCK = 512           # rows of a comparison block


def fingerprint(text: str) -> int:
    """The text's 64-bit fingerprint as a signed long."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    n = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        part = hashes[at:at + PIECE].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    return with_text_columns(df, text, [(name, T.LongType())], lambda ts: [[fingerprint(t) for t in ts]])


def tile_code(fp) -> "F.Column":
    """The four quarters' bit counts, ``FIELD`` bits each."""
    code = F.lit(0).cast("long")
    for q in range(QUARTERS):
        quarter = F.shiftrightunsigned(fp, 16 * q).bitwiseAND(F.lit(0xFFFF).cast("long"))
        code = code + F.shiftleft(F.bit_count(quarter).cast("long"), FIELD * q)
    return code


def near_offsets(radius: int = RADIUS) -> list[int]:
    """Code differences of tiles that may hold links: zero and one of each opposite pair.

    A count lies in 0..16, so an offset that leaves this range gives a code
    that no tile has (fields are ``FIELD`` bits wide)."""
    steps = [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    return sorted(sum(v << (FIELD * q) for q, v in enumerate(d)) for d in steps if d >= (0,) * QUARTERS)


class Forest:
    """Components over positions 0..n-1; keeps the links that join two of them."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def join(self, one: int, others: np.ndarray) -> None:
        roots, first = np.unique(self.label[others], return_index=True)
        own = self.label[one]
        new = roots != own
        if new.any():
            self.links += [(one, int(others[k])) for k in first[new]]
            self.label[np.isin(self.label, roots[new])] = own


def compare(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Spanning links (as values) among ``left`` and ``right``, or within ``left``."""
    both = left if right is None else np.concatenate([left, right])
    a = left.view(np.uint64)
    b = a if right is None else right.view(np.uint64)
    forest = Forest(len(both))
    shift = 0 if right is None else len(left)
    for at in range(0, len(a), BLOCK):
        bits = np.bitwise_count(a[at:at + BLOCK, None] ^ b[None, :])
        rows, cols = np.nonzero(bits <= radius)
        if right is None:
            below = cols > rows + at
            rows, cols = rows[below], cols[below]
        if len(rows):
            cuts = np.flatnonzero(np.diff(rows)) + 1
            for i, js in zip(rows[np.r_[0, cuts]], np.split(cols, cuts)):
                forest.join(int(i) + at, js + shift)
    return [(int(both[i]), int(both[j])) for i, j in forest.links]


def links(fps: DataFrame, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that span every component of distinct fingerprints ``fps``."""
    fps = fps.select(F.col(fp).alias("fp")).withColumn("tile", tile_code(F.col("fp")))
    # at most 17^4 rows: a proven bound for the broadcast
    counts = fps.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("n_chunks"))
    counts = stage(counts, "tiles")
    chunked = fps.join(F.broadcast(counts), "tile").withColumn(
        "chunk", F.pmod(F.xxhash64("fp"), F.col("n_chunks")).cast("int"))
    chunks = stage(chunked.groupBy("tile", "chunk").agg(F.sort_array(F.collect_list("fp")).alias("fps")), "chunks")
    offsets = F.explode(F.array(*[F.lit(d).cast("long") for d in near_offsets(radius)])).alias("offset")
    target = F.broadcast(counts.select(F.col("tile").alias("to_tile"), "n_chunks"))
    sent = (chunks.select("tile", "chunk", "fps", offsets)
            .withColumn("to_tile", F.col("tile") + F.col("offset")).join(target, "to_tile")
            .withColumn("to_chunk", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
            .where((F.col("offset") != 0) | (F.col("chunk") < F.col("to_chunk")))
            .select(F.col("to_tile").alias("tile"), F.col("to_chunk").alias("chunk"), F.lit(1).alias("guest"), "fps"))
    met = (chunks.select("tile", "chunk", F.lit(0).alias("guest"), "fps").unionByName(sent)
           .repartition("tile", "chunk").sortWithinPartitions("tile", "chunk", "guest"))
    return met.mapInArrow(lambda batches: _meet(batches, radius), "a long, b long")


def _meet(batches, radius: int):
    """Stream over chunks: each chunk's own row first, then the rows it is compared with."""
    key, own, guests, held = None, None, [], 0

    def flush():
        nonlocal guests, held
        if not guests:
            return []
        pairs = compare(own, np.concatenate(guests), radius)
        guests, held = [], 0
        return pairs

    def out(pairs):
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                           pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

    for batch in batches:
        tiles, chunks = batch.column("tile").to_pylist(), batch.column("chunk").to_pylist()
        guest, lists = batch.column("guest").to_pylist(), batch.column("fps")
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        found = []
        for k in range(len(batch)):
            fps = values[offsets[k]:offsets[k + 1]]
            if not guest[k]:
                found += flush()
                key, own = (tiles[k], chunks[k]), fps.copy()
                if len(own) > 1:
                    found += compare(own, None, radius)
                continue
            if key != (tiles[k], chunks[k]):
                raise ValueError("a compared row came before its chunk")
            guests.append(fps.copy())
            held += len(fps)
            if held >= 4 * CHUNK:
                found += flush()
        yield out(found)
    yield out(flush())


def components(edges: DataFrame) -> DataFrame:
    """Node and root of every node that has a link (columns node, root).

    Contraction: each node points to the smallest of itself and its
    neighbours by a hash that changes each round, links move to what they
    point to, and loops and repeats go, until no link is left. Random order
    makes the number of rounds logarithmic also for long chains."""
    edges = stage(edges.distinct(), "links")
    both = edges.select("a").union(edges.select("b"))
    found = both.distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    turn = 0
    while True:
        turn += 1
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("v"))  # noqa: E731,B023
        ends = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        to = (ends.groupBy("a").agg(F.min(rank("b")).alias("n"))
              .select("a", F.least(F.col("n"), rank("a")).getField("v").alias("to")))
        to = stage(to, "points")
        found = stage(found.join(to, found["root"] == to["a"], "left")
                      .select("node", F.coalesce("to", "root").alias("root")), "roots")
        one, two = to.toDF("a", "to_a"), to.toDF("b", "to_b")
        edges = stage(edges.join(one, "a").join(two, "b").where("to_a <> to_b")
                      .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
                      .distinct(), "links")
        if edges.isEmpty():
            return found


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    keep: list[str] | None = None) -> DataFrame:
    """Rows with columns fp, component_id, row and representative (true for one row per component).

    ``keep`` lists the columns to carry (default all). The representative is
    the row with the smallest id, the first such row if it is repeated.
    New names that clash are prefixed with underscores."""
    keep = keep if keep is not None else df.columns
    fp, row, comp, rep = (fresh(df, n) for n in ("fp", "row", "component_id", "representative"))
    rows = with_fingerprint(df.select(*dict.fromkeys([*keep, doc_id, text])), text, fp)
    if text not in keep:
        rows = rows.drop(text)
    # the row number is fixed by being written
    rows = stage(rows.withColumn(row, F.monotonically_increasing_id()), "fingerprints")
    first = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    nodes = stage(rows.groupBy(F.col(fp).alias("node")).agg(F.min(first).alias("first")), "nodes")
    found = components(links(nodes, "node"))
    # one row per fingerprint from here on
    rooted = nodes.join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    ids = (rooted.join(least, "root")
           .select(F.col("node").alias("_node"), F.col("least.id").alias(comp), F.col("least.row").alias("_least")))
    return (rows.join(ids, rows[fp] == ids["_node"])
            .withColumn(rep, F.col(row) == F.col("_least")).drop("_node", "_least"))


@pipeline_stage
def dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies."""
    rep = fresh(docs, "representative")
    return near_duplicates(docs).where(F.col(rep)).select(*docs.columns)
