"""Mixing: a numpy replay of the tree and its draws, and groups of equal rows."""

import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from tallywise.llm import mixing_tree as M  # noqa: E402

SF = "/root/testdata/sf0.01"


def spark_hash(*values):
    """xxhash64 of Spark: strings as bytes, (value, 4) as ints, longs; a null leaves the seed as it is."""
    h = 42
    for v in values:
        if v is None:
            continue
        data = v.encode() if isinstance(v, str) else int(v[0]).to_bytes(4, "little", signed=True) if isinstance(v, tuple) else int(v).to_bytes(8, "little", signed=True)
        h = xxhash.xxh64_intdigest(data, seed=h)
    return h - (1 << 64) if h >> 63 else h


def replay(rows, shards, seed):
    """taken, shards and places by (doc_id, twin), from the plan's rules alone."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(r[2] for r in rows if r[1] == s) for s in sources]
    wants = M.targets(sizes)
    number, twin = Counter(), []
    for r in rows:
        twin.append(number[r[0], r[2], r[3]])
        number[r[0], r[2], r[3]] += 1
    blocks, quotas, offset = {}, {}, {}
    for rank, s in enumerate(sources):
        own = [k for k, r in enumerate(rows) if r[1] == s]
        n_blocks = max(1, -(-len(own) // M.BLOCK))
        for turn in range(M.PASSES):
            want = max(0.0, min(float(sizes[rank]), wants[rank] - turn * sizes[rank]))
            if want <= 0:
                continue
            dealt = defaultdict(list)
            for k in own:
                draw = spark_hash((seed, 4), (rank, 4), (turn, 4), rows[k][0], rows[k][2], rows[k][3], twin[k])
                dealt[spark_hash(draw, (seed, 4)) % n_blocks].append((draw, k))
            left, last = want, None
            for b in sorted(dealt):
                words = sum(rows[k][2] for _, k in dealt[b])
                if left <= 0:
                    break
                last, room = b, left
                left -= words
            take = [(d, k, b) for b in dealt if b < last for d, k in dealt[b]]
            if sum(rows[k][2] for _, k in dealt[last]) <= room:
                take += [(d, k, last) for d, k in dealt[last]]
            else:
                block = sorted(dealt[last])
                take += [(*block[j], last) for j in M.fitting([rows[k][2] for _, k in block], room)]
            offset[rank, turn] = quotas.get(rank, 0)
            quotas[rank] = quotas.get(rank, 0) + last + 1
            blocks[rank, turn] = take
    ranks = sorted(quotas)
    table = M.split_quotas([quotas[k] for k in ranks], shards, seed)
    ends = {k: np.cumsum(table[:, j]) for j, k in enumerate(ranks)}
    drawn = defaultdict(list)
    for (rank, turn), take in blocks.items():
        for draw, k, b in take:
            drawn[k].append((int(np.searchsorted(ends[rank], offset[rank, turn] + b, side="right")), draw))
    return sorted((r[0], r[2] * len(drawn[k]), ",".join(str(s) for s, _ in sorted(drawn[k])), ",".join(str(p) for _, p in sorted(drawn[k])))
                  for k, r in enumerate(rows))


def test_a_replay_of_tree_and_draws_takes_the_same(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    docs = docs.unionByName(docs.where("doc_id < 5")).unionByName(docs.where("doc_id < 5"))  # rows three times
    rows = [tuple(r) for r in docs.select("doc_id", "source", M.word_count(F.col("text")), F.xxhash64("text")).collect()]
    results = {}
    for seed in (M.SEED, 7):
        got = M.mix_sizes(docs, 16, seed)
        results[seed] = sorted((r.doc_id, r.taken, r["shards"], r["places"]) for r in got.collect())
        want = replay(rows, 16, seed)
        assert [x for x in results[seed] if x[0] >= 5] == [x for x in want if x[0] >= 5]
        assert Counter(results[seed]) == Counter(want)
    assert [x[:3] for x in results[M.SEED]] != [x[:3] for x in results[7]]


def test_equal_rows_fall_into_many_blocks(spark):
    """60,000 rows with a null id and one text: blocks, and so the tasks of the last ones, stay even."""
    docs = spark.range(0, 60_000, numPartitions=7).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit("two words").alias("text"))
    rows, size, key, draws_on = M.keyed_sizes(docs, ["doc_id", "source"])
    twin = draws_on[-1]
    assert sorted(r[0] for r in rows.select(twin).collect()) == list(range(60_000))
    passes = spark.createDataFrame([("a", 0, 235, 0)], "s_source string, rank int, n_blocks int, pass int")
    sizes = [r["count"] for r in M.deal(rows, passes, draws_on, "source").groupBy("block").count().collect()]
    assert len(sizes) == 235 and max(sizes) <= 2 * np.median(sizes)
    got = M.mix_sizes(docs)
    taken = got.agg(F.sum("taken")).first()[0]
    assert abs(taken - 180_000) <= 1


def test_the_last_block_comes_near_what_is_left():
    assert M.fitting([], 5.0) == [] and M.fitting([5, 5], 10.0) == [0, 1]
    assert M.fitting([7, 4, 6], 10.0) == [0, 1] and M.fitting([6, 5, 9], 10.0) == [0, 1]  # one over is nearer than three under
    assert M.fitting([20], 9.0) == [] and M.fitting([20], 11.0) == [0]
    draw = np.random.default_rng(3)
    for _ in range(200):
        sizes, room = draw.integers(0, 50, draw.integers(1, 9)).tolist(), float(draw.integers(1, 120))
        got = M.fitting(sizes, room)
        greedy, left = 0, room
        for n in sizes:
            if n <= left:
                greedy, left = greedy + n, left - n
        assert len(set(got)) == len(got) and abs(room - sum(sizes[k] for k in got)) <= abs(room - greedy)
