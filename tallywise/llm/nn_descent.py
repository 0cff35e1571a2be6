"""Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node. The neighbour graph starts from exact comparison
within blocks of vectors that share a random-hyperplane code (``TABLES``
codes), and is improved by rounds of NN-descent: each node's pool holds itself, its
neighbours and the nodes that have it as a neighbour;
within a pool members are compared with each other (neighbours of
neighbours) where one of the two came in by an edge that is new since the round before, and
what beats a member's worst neighbour is sent to that member. Pools without a new edge are
not compared. Rounds go on until less than ``CHANGED`` of all neighbours are new.
Pools and blocks are compared in pieces of ``PIECE`` members, and those of hubs
are dealt to several tasks, so a hot vector's pool is no unit of work.
Nodes are dealt to parts of some ``NODES``. What goes from part to part in a round (edges, members of
pools, candidates) travels as arrays in binary columns, a row for each pair of parts, since
an edge, of which a node has some 50, would cost far more as a row.

A query (a row of the table, or any vector) searches greedily: a beam of the
nearest nodes found; all nodes of the beam not yet expanded are
expanded (their neighbours, either way), until none is left. The beam has
``BEAM`` nodes at first. ``PROBES`` queries are also compared with every node, and
while they find less than ``RECALL`` of their true neighbours, the beam is doubled; what
they found is logged. Rows with equal vectors share one search.
For the search each node has the vectors of its neighbours in its row. These rows are kept by key on the executors' disks;
all queries of a block take a step together, in which only the nodes to expand and what enters a beam move.
A block has ``QUERIES`` queries or a ``PART``-th of the nodes, so the number of
blocks, each reading the graph once a step, does not grow with the table; blocks are smaller as the beam grows.
The ``RERANK`` best of each beam are scored again in double precision on the original
vectors, copies are put back, and the nearest are returned.

Vectors travel as 8-bit integers with a scale; only the last step needs more.
The index is fitted on every row.

Defined cases: vectors that are null, of another length than most, zero, or hold null or
non-finite components take no part, as queries or candidates; fewer candidates
than asked for are all returned; ties go to the smaller id; rows with equal ids
and vectors count once; rows with equal ids and other vectors are rows of their own, each a query with its own ranks
and a candidate of the other; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import logging
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywise.llm.common import stage

NEIGHBOURS = 24
TABLES = 2
BLOCK = 512           # vectors that share a code, about
PIECE = 1024
CHANGED = 0.05        # share of new neighbours below which the graph counts as settled
SENT = 16             # candidates that a pool sends to a member
BEAM = 256            # to begin with
PROBES = 128
RECALL = 0.95         # of the probes' true neighbours that must be found
QUERIES = 2048        # of a block, at least
PART = 48             # or this part of the nodes
RERANK = 24
HUB = 4096            # members from which a pool is dealt to several tasks
SALT_BITS = 20        # of a pool's key, for the task
NODES = 16384         # of a part, whose nodes and pools a task holds
LINKS = 64            # neighbours in a row of the search's graph
CELLS = 1 << 19       # similarities or components that are held at once
SEND_ROWS = 1 << 20   # candidates that leave in one go
MANY = 1024           # of them for one node, from which its best are sorted out first
SEED = 11

log = logging.getLogger(__name__)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and vec (array<double>) of the rows that take part."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", fine)
                      & F.exists("vec", lambda x: x != 0))
    top = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (top["n"] if top else 0))


def pack(vec: np.ndarray) -> list[bytes]:
    """Unit vectors as a 32-bit scale and 8-bit components."""
    unit = vec / np.abs(vec).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127.0
    small = np.rint(unit / scale[:, None]).astype(np.int8)
    return [s.tobytes() + v.tobytes() for s, v in zip(scale.astype(np.float32), small)]


def unpack(column: pa.Array) -> np.ndarray:
    """Packed vectors of an Arrow binary column as 32-bit floats."""
    if not len(column):
        return np.empty((0, 0), np.float32)
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    scale = raw[:, :4].copy().view(np.float32)
    return raw[:, 4:].view(np.int8).astype(np.float32) * scale


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def packed_nodes(nodes: DataFrame) -> DataFrame:
    """id and packed vector."""
    def run(batches):
        for b in batches:
            m = _matrix(b.column("vec"))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(pack(m) if len(m) else [], pa.binary())], ["id", "packed"])

    return nodes.select("id", "vec").mapInArrow(run, "id long, packed binary")


# ---------------------------------------------------------------- packets

#: What travels between parts of the nodes: whole numpy arrays as bytes, so an edge is no row.
PACKET = "home int, kind int, a binary, b binary, c binary, d binary, e binary, f binary"


def parts_of(graph: DataFrame) -> int:
    """How many parts the nodes are dealt into by ``_home``."""
    nodes = graph.count()
    return max(min(2 * graph.sparkSession.sparkContext.defaultParallelism, nodes // 1024 + 1), nodes // NODES + 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _home(keys: np.ndarray, parts: int) -> np.ndarray:
    return (_mixed(keys) % np.uint64(parts)).astype(np.int32)


def _pool_keys(pools: np.ndarray, ids: np.ndarray, hubs: dict[int, int]) -> np.ndarray:
    """The pool and, in a hub's, the piece (salt) that a member goes to, as one number."""
    keys = pools << SALT_BITS
    if hubs:
        hub = np.array(sorted(hubs), np.int64)
        at = np.minimum(np.searchsorted(hub, pools), len(hub) - 1)
        hot = np.flatnonzero(hub[at] == pools)
        salts = np.array([hubs[h] for h in hub.tolist()], np.uint64)[at[hot]]
        keys[hot] += (_mixed(ids[hot] + SEED) % salts).astype(np.int64)
    return keys


def _dealt(homes: np.ndarray):
    """Each home with the places of its entries."""
    order = np.argsort(homes.astype(np.uint16) if len(homes) and homes.max() < 1 << 16 else homes, kind="stable")
    cuts = np.flatnonzero(np.diff(homes[order])) + 1
    for at in np.split(order, cuts) if len(order) else []:
        yield int(homes[at[0]]), at


def _packets(rows: list[tuple]) -> pa.RecordBatch:
    """``rows`` have home, kind and up to six arrays."""
    held = [[r[2 + k].tobytes() if len(r) > 2 + k else None for r in rows] for k in range(6)]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                       *(pa.array(h, pa.binary()) for h in held)], ["home", "kind", *"abcdef"])


def _by_home(batches):
    """Each home with what came for it: by kind a list of rows of bytes."""
    home, got = None, {}
    for b in batches:
        homes, kinds = b.column("home").to_pylist(), b.column("kind").to_pylist()
        for k, at in enumerate(homes):
            if at != home:
                if home is not None:
                    yield home, got
                home, got = at, {}
            got.setdefault(kinds[k], []).append([b.column(c)[k].as_py() for c in "abcdef"])
    if home is not None:
        yield home, got


def _joined(rows: list, k: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[k] for r in rows), kind)


def to_homes(packets: DataFrame, parts: int) -> DataFrame:
    return packets.repartition(parts, "home").sortWithinPartitions("home")


def _binary(raw: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column of values of ``sizes`` bytes that follow each other in ``raw``."""
    ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and the size of each value."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return raw[ends[0]:ends[-1]], np.diff(ends)


# ---------------------------------------------------------------- graph

def coded(packed: DataFrame, bits: int, parts: int, hubs: dict[int, int]) -> DataFrame:
    """Packets that bring each node once per table to the pool of its hyperplane code."""
    def run(batches):
        for b in batches:
            vec, ids = unpack(b.column("packed")), b.column("id").to_numpy()
            if not len(vec):
                continue
            raw = _bytes(b.column("packed"))[0].reshape(len(ids), -1)
            out = []
            for t in range(TABLES):
                planes = np.random.default_rng([SEED, t]).standard_normal((vec.shape[1], max(bits, 1)))
                code = ((vec @ planes > 0) @ (1 << np.arange(max(bits, 1)))) if bits else np.zeros(len(vec), np.int64)
                keys = _pool_keys(code.astype(np.int64) * TABLES + t, ids, hubs)
                for home, at in _dealt(_home(keys, parts)):
                    out.append((home, 0, keys[at], np.arange(len(at), dtype=np.int32), np.ones(len(at), bool), ids[at],
                                np.full(len(at), -9.0, np.float32), raw[at]))
            yield _packets(out)

    return packed.mapInArrow(run, PACKET)


def _rolled(batches, parts: int):
    """Of each node its vector, worst neighbour and neighbours (kind 0), and each edge at the end that it leads to (kind 1)."""
    for b in batches:
        if not len(b):
            continue
        ids, raw = b.column("id").to_numpy(), _bytes(b.column("packed"))[0].reshape(len(b), -1)
        nbrs, sims = b.column("nbrs").flatten().to_numpy(), b.column("sims").flatten().to_numpy()
        new = b.column("new").flatten().to_numpy(zero_copy_only=False).astype(bool)
        counts = pc.list_value_length(b.column("nbrs")).to_numpy().astype(np.int32)
        starts = np.cumsum(counts) - counts
        least = np.full(len(ids), -9.0, np.float32)
        full = counts >= NEIGHBOURS
        least[full] = sims[(starts + counts - 1)[full]]  # the neighbours are in order
        out = []
        for home, at in _dealt(_home(ids, parts)):
            own = np.repeat(starts[at] - (np.cumsum(counts[at]) - counts[at]), counts[at]) + np.arange(counts[at].sum())
            out.append((home, 0, ids[at], raw[at], least[at], counts[at], nbrs[own], new[own]))
        back = np.repeat(ids, counts)
        out += [(home, 1, nbrs[at], back[at], new[at]) for home, at in _dealt(_home(nbrs, parts))]
        yield _packets(out)


def _roster(batches, parts: int, hubs: dict[int, int]):
    """Packets that bring each node to the pools that it is in: its own, its neighbours' and those of the nodes that have it as a neighbour.

    A vector goes to a home once, whatever the number of its pools there."""
    for _, got in _by_home(batches):
        if 0 not in got:
            continue
        ids, least, counts = _joined(got[0], 0, np.int64), _joined(got[0], 2, np.float32), _joined(got[0], 3, np.int32)
        raw = _joined(got[0], 1, np.uint8).reshape(len(ids), -1)
        back = got.get(1, [])
        to, from_ = _joined(back, 0, np.int64), _joined(back, 1, np.int64)
        order = np.argsort(ids)
        at_back = order[np.searchsorted(ids, to, sorter=order)]
        at = np.concatenate([np.arange(len(ids)), np.repeat(np.arange(len(ids)), counts), at_back]).astype(np.int32)
        pools = np.concatenate([ids, _joined(got[0], 4, np.int64), from_])
        new = np.concatenate([np.zeros(len(ids), bool), _joined(got[0], 5, bool), _joined(back, 2, bool)])
        keys = _pool_keys(pools, ids[at], hubs)
        for home, k in _dealt(_home(keys, parts)):
            seen, place = np.unique(at[k], return_inverse=True)
            yield _packets([(home, 0, keys[k], place.astype(np.int32), new[k], ids[seen], least[seen], raw[seen])])


def _pools(rows: list):
    """Members in order of their pools, who is in twice once and new if one edge is: pool keys, places, new; ids, least and bytes by place."""
    keys, new = _joined(rows, 0, np.int64), _joined(rows, 2, bool)
    first = np.cumsum([0] + [len(r[3]) // 8 for r in rows])[:-1]
    place = _joined(rows, 1, np.int32) + np.repeat(first, [len(r[1]) // 4 for r in rows])
    ids, least = _joined(rows, 3, np.int64), _joined(rows, 4, np.float32)
    _, rank = np.unique(keys, return_inverse=True)
    both = (rank.astype(np.int64) << 32) | place
    order = np.argsort(both)
    starts = np.flatnonzero(np.r_[True, np.diff(both[order]) != 0])
    at = order[starts]
    return keys[at], place[at], np.logical_or.reduceat(new[order], starts), ids, least, _joined(rows, 5, np.uint8).reshape(len(ids), -1)


def _floats(raw: np.ndarray) -> np.ndarray:
    """Packed vectors, a row of bytes each, as 32-bit floats."""
    return raw[..., 4:].view(np.int8).astype(np.float32) * np.ascontiguousarray(raw[..., :4]).view(np.float32)


def _send(ids: np.ndarray, vec: np.ndarray, least: np.ndarray, new: np.ndarray, keep: int, sizes: np.ndarray | None = None):
    """Per member its best others in its pool that beat its worst neighbour; one of each pair is new.

    The pools have ``sizes`` members, one after the other; without it all are one pool.
    Returned are members, how many others each gets, and all these others and similarities in order."""
    sizes = np.array([len(ids)]) if sizes is None else sizes
    m = int(sizes.max())
    held = np.arange(m) < sizes[:, None]
    slot = np.where(held, (np.cumsum(sizes) - sizes)[:, None] + np.arange(m), 0)
    x = vec[slot]
    sims = x @ x.transpose(0, 2, 1)
    fresh = new[slot] & held
    good = sims > np.where(held, least[slot], np.float32(9.0))[:, :, None]
    good &= (fresh[:, :, None] | fresh[:, None, :]) & held[:, None, :]
    good[:, np.arange(m), np.arange(m)] = False
    counts = good.sum(axis=2)
    over = counts > keep
    if over.any():
        rows = np.where(good[over], sims[over], np.float32(-9.0))
        best = np.argpartition(-rows, keep - 1, axis=1)[:, :keep]
        kept = np.zeros(rows.shape, bool)
        np.put_along_axis(kept, best, True, 1)
        good[over] = kept
        counts[over] = keep
    pool, _, other = np.nonzero(good)
    some = counts > 0
    return ids[slot[some]], counts[some], ids[slot[pool, other]], sims[good]


def _compared(batches, parts: int, keep: int):
    """What each pool sends to its members (kind 1): members, others, similarities."""
    for _, got in _by_home(batches):
        keys, place, new, ids, least, raw = _pools(got.pop(0))
        starts = np.flatnonzero(np.r_[True, np.diff(keys) != 0])
        sizes = np.diff(np.r_[starts, len(keys)])
        pieces = -(-sizes // PIECE)
        first = np.repeat(starts, pieces) + PIECE * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        sizes = np.minimum(PIECE, np.repeat(starts + sizes, pieces) - first)
        useful = (sizes > 1) & np.logical_or.reduceat(new, first)
        # pools of about one size are compared together, the largest first, so that no later one is larger than the first of its group
        order = np.flatnonzero(useful)[np.argsort(-sizes[useful], kind="stable")]
        sent, held, a = [], 0, 0
        while a < len(order):
            m = int(sizes[order[a]])
            z = a + max(1, CELLS // (m * max(m, 64)))
            own = order[a:z]
            rows = np.repeat(first[own] - (np.cumsum(sizes[own]) - sizes[own]), sizes[own]) + np.arange(sizes[own].sum())
            at = place[rows]
            members, counts, others, sims = _send(at, _floats(raw[at]), least[at], new[rows], keep, sizes[own])
            sent.append((np.repeat(members, counts), others, sims))
            held, a = held + len(others), z
            if held >= SEND_ROWS or a >= len(order):
                members, others, sims = (np.concatenate([x[k] for x in sent]) for k in range(3))
                sent, held = [], 0
                many = np.bincount(members)[members] > MANY if len(members) else np.zeros(0, bool)
                if many.any():  # a hub is sent many; only its best matter
                    few, hot = np.flatnonzero(~many), np.flatnonzero(many)
                    hot = hot[_nearest(members[hot], ids[others[hot]], sims[hot], np.ones(len(hot), bool))]
                    members, others, sims = (x[np.r_[few, hot]] for x in (members, others, sims))
                members, others = ids[members], ids[others]
                yield _packets([(home, 1, members[k], others[k], sims[k]) for home, k in _dealt(_home(members, parts))])


GRAPH = "id long, packed binary, nbrs array<long>, sims array<float>, new array<boolean>, changed int"


def _owned(batches, parts: int):
    """Each node with its vector, neighbours and similarities (kind 0), for ``_merged``."""
    for b in batches:
        if not len(b):
            continue
        ids, raw = b.column("id").to_numpy(), _bytes(b.column("packed"))[0].reshape(len(b), -1)
        nbrs, sims = b.column("nbrs").flatten().to_numpy(), b.column("sims").flatten().to_numpy()
        counts = pc.list_value_length(b.column("nbrs")).to_numpy().astype(np.int32)
        starts = np.cumsum(counts) - counts
        out = []
        for home, at in _dealt(_home(ids, parts)):
            own = np.repeat(starts[at] - (np.cumsum(counts[at]) - counts[at]), counts[at]) + np.arange(counts[at].sum())
            out.append((home, 0, ids[at], raw[at], counts[at], nbrs[own], sims[own]))
        yield _packets(out)


def _nearest(row: np.ndarray, cand: np.ndarray, sims: np.ndarray, late: np.ndarray) -> np.ndarray:
    """Places of the NEIGHBOURS best of each row, row by row and nearest first, ties to the smaller id.

    A candidate counts once in its row, by an entry that isn't ``late`` if there is one."""
    rows = row.astype(np.uint64)
    key = (rows << np.uint64(41)) | (cand.astype(np.uint64) << np.uint64(1)) | late.astype(np.uint64)
    by = np.argsort(key)
    by = by[np.r_[True, np.diff(key[by] >> np.uint64(1)) != 0][:len(by)]]
    far = ((2.0 - sims[by].astype(np.float64)) * (1 << 30)).astype(np.uint64)
    by = by[np.argsort((rows[by] << np.uint64(32)) | far, kind="stable")]
    held = np.bincount(row[by])
    return by[np.arange(len(by)) - np.repeat(np.cumsum(held) - held, held) < NEIGHBOURS]


def _merged(batches):
    """Rows of the graph: each node's best of its neighbours and what was sent to it, which is new, and how many."""
    for _, got in _by_home(batches):
        own, sent = got[0], got.get(1, [])
        ids, counts = _joined(own, 0, np.int64), _joined(own, 2, np.int32)
        raw = _joined(own, 1, np.uint8).reshape(len(ids), -1)
        order = np.argsort(ids)
        row = np.concatenate([np.repeat(np.arange(len(ids)), counts),
                              order[np.searchsorted(ids, _joined(sent, 0, np.int64), sorter=order)]])
        cand = np.concatenate([_joined(own, 3, np.int64), _joined(sent, 1, np.int64)])
        sims = np.concatenate([_joined(own, 4, np.float32), _joined(sent, 2, np.float32)])
        late = np.arange(len(cand)) >= int(counts.sum())
        by = _nearest(row, cand, sims, late)
        held = np.bincount(row[by], minlength=len(ids))
        changed = np.bincount(row[by], weights=late[by], minlength=len(ids)).astype(np.int32)
        ends = np.r_[0, np.cumsum(held)]
        for a in range(0, len(ids), 4096):
            z = min(len(ids), a + 4096)
            k, cut = by[ends[a]:ends[z]], pa.array((ends[a:z + 1] - ends[a]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[a:z]), _binary(raw[a:z], np.full(z - a, raw.shape[1])), pa.ListArray.from_arrays(cut, pa.array(cand[k])),
                 pa.ListArray.from_arrays(cut, pa.array(sims[k])), pa.ListArray.from_arrays(cut, pa.array(late[k])), pa.array(changed[a:z])],
                ["id", "packed", "nbrs", "sims", "new", "changed"])


def compare_and_merge(graph: DataFrame, roster: DataFrame, parts: int, keep: int) -> DataFrame:
    """The graph with what the pools of ``roster`` send to their members."""
    sent = to_homes(roster, parts).mapInArrow(lambda b: _compared(b, parts, keep), PACKET)
    own = graph.select("id", "packed", "nbrs", "sims").mapInArrow(lambda b: _owned(b, parts), PACKET)
    return stage(to_homes(own.unionByName(sent), parts).mapInArrow(_merged, GRAPH), "graph")


def crowded(pools: DataFrame, parts: int) -> dict[int, int]:
    """The pools of more than HUB members, and how many tasks share each; ``pools`` (home, a) has a pool for each member."""
    def run(batches):
        home, held = None, []

        def found():
            ids, n = np.unique(np.frombuffer(b"".join(held), np.int64), return_counts=True)
            big = n > HUB - NEIGHBOURS - 1
            return pa.RecordBatch.from_arrays([pa.array(ids[big]), pa.array(n[big].astype(np.int64))], ["pool", "n"])

        for b in batches:
            for at, ids in zip(b.column("home").to_pylist(), b.column("a").to_pylist()):
                if at != home and held:
                    yield found()
                    held = []
                home = at
                held.append(ids)
        yield found()

    rows = to_homes(pools, parts).mapInArrow(run, "pool long, n long").collect()  # a 170th of the nodes at most
    return {r["pool"]: -(-r["n"] // HUB) + 1 for r in rows}


def edge_ends(graph: DataFrame, parts: int) -> DataFrame:
    return graph.select("id", "packed", "nbrs", "sims", "new").mapInArrow(lambda b: _rolled(b, parts), PACKET)


def roster_of(graph: DataFrame, parts: int) -> tuple[DataFrame, dict[int, int]]:
    """Packets with the members of every node's pool, and the hubs."""
    ends = edge_ends(graph, parts)
    hubs = crowded(ends.where("kind = 1").select("home", "a"), parts)
    return to_homes(ends, parts).mapInArrow(lambda b: _roster(b, parts, hubs), PACKET), hubs


def descend(graph: DataFrame) -> DataFrame:
    """One round: pools of neighbours of either direction that hold a new edge, compared and merged."""
    parts = parts_of(graph)
    return compare_and_merge(graph, roster_of(graph, parts)[0], parts, SENT)


def forget(df: DataFrame) -> None:
    """Let Spark's cleaner remove the shuffle files of steps that are written: it works when the JVM collects garbage."""
    df.sparkSession.sparkContext._jvm.System.gc()


def build_graph(nodes: DataFrame) -> DataFrame:
    """id, packed, nbrs, sims of every node, and which neighbours the last round found."""
    packed = stage(packed_nodes(nodes), "packed")
    bits, parts = max(0, int(np.floor(np.log2(max(1, packed.count() / BLOCK))))), parts_of(packed)
    empty = packed.select("id", "packed", F.array().cast("array<bigint>").alias("nbrs"), F.array().cast("array<float>").alias("sims"))
    hubs = {k >> SALT_BITS: n for k, n in crowded(coded(packed, bits, parts, {}).select("home", "a"), parts).items()}
    graph = compare_and_merge(empty, coded(packed, bits, parts, hubs), parts, NEIGHBOURS)
    while True:  # ends: each node's neighbours only ever become nearer
        graph = descend(graph)
        changed, held = graph.agg(F.sum("changed"), F.sum(F.size("nbrs"))).first()
        forget(graph)
        if not held or changed < CHANGED * held:
            return graph


# ---------------------------------------------------------------- search

def _linked(batches):
    """key (node, and a hub's salt), ids and vecs: the nodes at the other ends of its edges and their packed vectors, LINKS at a time."""
    for _, got in _by_home(batches):
        keys, place, _, ids, _, raw = _pools(got.pop(0))
        other = ids[place] != keys >> SALT_BITS
        keys, place = keys[other], place[other]
        if not len(keys):
            continue
        starts = np.flatnonzero(np.r_[True, np.diff(keys) != 0])
        sizes = np.diff(np.r_[starts, len(keys)])
        pieces = -(-sizes // LINKS)
        first = np.repeat(starts, pieces) + LINKS * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        sizes = np.minimum(LINKS, np.repeat(starts + sizes, pieces) - first)
        for a in range(0, len(first), 1024):
            z = min(len(first), a + 1024)
            at = place[first[a]:first[z - 1] + sizes[z - 1]]
            yield pa.RecordBatch.from_arrays([pa.array(keys[first[a:z]]), _binary(ids[at], sizes[a:z] * 8),
                                              _binary(raw[at], sizes[a:z] * raw.shape[1])], ["key", "ids", "vecs"])


def links_of(graph: DataFrame, parts: int) -> tuple[DataFrame, dict[int, int]]:
    """The graph for the search (``_linked``), kept by key on the executors' disks so that no step moves it; the hubs."""
    roster, hubs = roster_of(graph, parts)
    links = stage(to_homes(roster, parts).mapInArrow(_linked, "key long, ids binary, vecs binary"), "links")
    return links.repartition(parts, "key").persist(StorageLevel.DISK_ONLY), hubs


def _front(batches, beam: int, hubs: dict[int, int]):
    """A row for each node to expand, and for each salt of a hub; ``least`` is what a node must beat to enter the beam."""
    for b in batches:
        out = []
        for q, packed, ids, sims, done in zip(*(b.column(c).to_pylist() for c in ("query", "q_packed", "ids", "sims", "done"))):
            ids, sims = np.frombuffer(ids, np.int64), np.frombuffer(sims, np.float32)
            keys = ids[~np.frombuffer(done, bool)] << SALT_BITS
            if hubs:
                keys = np.concatenate([keys, *(k + np.arange(1, hubs[k >> SALT_BITS]) for k in keys.tolist() if k >> SALT_BITS in hubs)])
            if len(keys):
                out.append((q, packed, sims[-1] if len(ids) >= beam else -9.0, keys))
        counts = np.array([len(x[3]) for x in out], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([x[0] for x in out], np.int64), counts)),
             pa.array([x[1] for x in out], pa.binary()).take(pa.array(np.repeat(np.arange(len(out)), counts))),
             pa.array(np.repeat(np.array([x[2] for x in out], np.float32), counts)),
             pa.array(np.concatenate([np.empty(0, np.int64), *(x[3] for x in out)]))], ["query", "q_packed", "least", "at"])


def _score(batches):
    """Similarity of each query and the nodes linked to one that it expands; only what may enter the beam goes on."""
    for b in batches:
        for a in range(0, len(b), 512):
            part = b.slice(a, 512)
            q, least = unpack(part.column("q_packed")), part.column("least").to_numpy()
            ids, sizes = _bytes(part.column("ids"))
            counts = sizes // 8
            row = np.repeat(np.arange(len(part)), counts)
            vec = _floats(_bytes(part.column("vecs"))[0].reshape(len(row), -1))
            sims = np.einsum("ij,ij->i", vec, q[row])
            good = np.flatnonzero(sims > least[row])
            got = np.bincount(row[good], minlength=len(part))
            some = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([part.column("query").take(pa.array(some)), _binary(ids.view(np.int64)[good], got[some] * 8),
                                              _binary(sims[good].astype(np.float32), got[some] * 4)], ["query", "ids", "sims"])


BEAMS = "query long, q_packed binary, ids binary, sims binary, done binary, left int"


def _beam(batches, beam: int):
    """Per query the ``beam`` nearest of its beam (its first row), all expanded, and the scored (the others), and how many are to be expanded."""
    query, packed, parts, known = None, None, [], 0

    def best():
        ids, sims = (_joined(parts, k, t) for k, t in ((0, np.int64), (1, np.float32)))
        ids, first = np.unique(ids, return_index=True)  # who is in the beam already comes first and keeps its place there
        sims = sims[first]
        top = np.lexsort((ids, -sims))[:beam]
        done = first[top] < known
        return query, packed, ids[top].tobytes(), sims[top].tobytes(), done.tobytes(), int((~done).sum())

    def batch_of(rows):
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                          ["query", "q_packed", "ids", "sims", "done", "left"])

    for b in batches:
        out = []
        for q, own, ids, sims in zip(*(b.column(c).to_pylist() for c in ("query", "q_packed", "ids", "sims"))):
            if own is not None:
                if parts:
                    out.append(best())
                query, packed, parts, known = q, own, [], len(ids) // 8
            parts.append((ids, sims))
        yield batch_of(out)
    if parts:
        yield batch_of([best()])


def search(links: DataFrame, hubs: dict[int, int], parts: int, block: DataFrame, beam: int = BEAM) -> DataFrame:
    """The RERANK nearest found (query, ids) for a block of queries (query, node, q_packed): ``node`` is where each starts."""
    def begun(batches):
        for b in batches:
            n = len(b)
            yield pa.RecordBatch.from_arrays(
                [b.column("query"), b.column("q_packed"), _binary(b.column("node").to_numpy(), np.full(n, 8)), _binary(np.ones(n, np.float32), np.full(n, 4)),
                 _binary(np.zeros(n, bool), np.ones(n, int)), pa.array(np.ones(n, np.int32))], ["query", "q_packed", "ids", "sims", "done", "left"])

    def ended(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("query"), pa.array([np.frombuffer(x, np.int64)[:RERANK] for x in b.column("ids").to_pylist()],
                                                                          pa.list_(pa.int64()))], ["query", "ids"])

    beams = stage(block.select("query", "q_packed", "node").mapInArrow(begun, BEAMS), "beam")
    while beams.agg(F.sum("left")).first()[0]:  # a beam only improves, so at last it has nothing left to expand
        front = (beams.where("left > 0").mapInArrow(lambda b: _front(b, beam, hubs), "query long, q_packed binary, least float, at long")
                 .repartition(parts, "at"))
        # of the two the front is the smaller in every partition; the links stay where they are
        near = links.join(front.hint("shuffle_hash"), F.col("key") == F.col("at")).select("query", "q_packed", "least", "ids", "vecs")
        scored = near.mapInArrow(_score, "query long, ids binary, sims binary")
        rows = (beams.select("query", "q_packed", "ids", "sims").unionByName(scored, allowMissingColumns=True)
                .repartition("query").sortWithinPartitions("query", F.col("q_packed").isNull()))
        beams = stage(rows.mapInArrow(lambda b: _beam(b, beam), BEAMS), "beam")
        forget(beams)
    return beams.mapInArrow(ended, "query long, ids array<long>")


def true_neighbours(nodes: DataFrame, probes: DataFrame, k: int) -> dict[int, set[int]]:
    """The k nearest other nodes of each probe (query, node, q_vec), by comparison with all nodes."""
    rows = probes.collect()  # PROBES at most
    ids, own = np.array([r["query"] for r in rows], np.int64), np.array([r["node"] for r in rows], np.int64)

    def unit(m):
        m = m / np.abs(m).max(axis=1, keepdims=True)
        return m / np.linalg.norm(m, axis=1, keepdims=True)

    asked = unit(np.array([r["q_vec"] for r in rows], np.float64).reshape(len(rows), -1)) if rows else None

    def run(batches):
        best_n, best_s = np.full((len(ids), 0), 0, np.int64), np.zeros((len(ids), 0))
        for b in batches:
            if not len(b) or asked is None:
                continue
            at = b.column("id").to_numpy()
            s = asked @ unit(_matrix(b.column("vec"))).T
            s[own[:, None] == at[None, :]] = -9.0
            best_n, best_s = np.hstack([best_n, np.broadcast_to(at, s.shape)]), np.hstack([best_s, s])
            if best_s.shape[1] > k:
                top = np.argpartition(-best_s, k - 1, axis=1)[:, :k]
                best_n, best_s = np.take_along_axis(best_n, top, 1), np.take_along_axis(best_s, top, 1)
        q = np.repeat(ids, best_n.shape[1])
        fine = best_s.ravel() > -2.0
        yield pa.RecordBatch.from_arrays([pa.array(q[fine]), pa.array(best_n.ravel()[fine]), pa.array(best_s.ravel()[fine])], ["query", "node", "sim"])

    # PROBES x k rows a task
    order = W.partitionBy("query").orderBy(F.desc("sim"), "node")
    top = (nodes.select("id", "vec").mapInArrow(run, "query long, node long, sim double")
           .withColumn("place", F.row_number().over(order)).where(F.col("place") <= k))
    out: dict[int, set[int]] = {}
    for r in top.collect():
        out.setdefault(r["query"], set()).add(r["node"])
    return out


def probe_recall(beams: DataFrame, truth: dict[int, set[int]]) -> float:
    """The share of the probes' true neighbours among the RERANK best of their beams."""
    got = beams.where(F.col("query").isin([int(q) for q in truth])).select("query", "ids").collect()
    hit = sum(len(truth[r["query"]] & set(r["ids"])) for r in got)
    return hit / max(1, sum(map(len, truth.values())))


def fitted_beam(nodes: int, recall: float, probe) -> int:
    """The smallest doubling of BEAM at which the probes find RECALL of their true neighbours.

    ``recall`` is what they find with BEAM, ``probe`` gives it for a larger beam.
    A beam of all nodes is as far as it goes."""
    beam = BEAM
    while recall < RECALL and beam < nodes:
        beam *= 2
        recall = probe(beam)
    return beam


def cosine(batches):
    """The exact cosine in double precision, row by row, so equal vectors score equally."""
    for b in batches:
        a, c = _matrix(b.column("q_vec")), _matrix(b.column("vec"))
        if len(a):
            with np.errstate(over="ignore", under="ignore"):
                score = (a * c).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((c * c).sum(axis=1)))
        else:
            score = np.empty(0)
        yield pa.RecordBatch.from_arrays([b.column("query"), b.column("node"), pa.array(score, pa.float64())],
                                         ["query", "node", "score"])


def numbered(nodes: DataFrame) -> DataFrame:
    """``id`` from 0 without gaps; before it holds a file's number and the place there."""
    file, place = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    sizes = nodes.groupBy(file.alias("file")).count().orderBy("file").collect()  # a row for each file
    firsts = np.cumsum([0] + [r["count"] for r in sizes]).tolist()
    first = nodes.sparkSession.createDataFrame([(r["file"], n) for r, n in zip(sizes, firsts)], "file long, first long")
    return nodes.join(F.broadcast(first), file == F.col("file")).select((place + F.col("first")).alias("id"), "vec")


def nearest(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``."""
    rows = stage(usable(vectors, vec_id, vector).distinct(), "vectors")
    # the copies that a result can hold: the k + 1 smallest ids of each vector, pre-selected in every task
    copies = stage(rows.withColumn("copy", F.row_number().over(W.partitionBy("vec").orderBy("vec_id"))).where(F.col("copy") <= k + 1), "copies")
    nodes = numbered(stage(copies.where("copy = 1").select(F.monotonically_increasing_id().alias("id"), "vec"), "nodes"))
    by_vector = nodes.select(F.col("id").alias("node"), F.col("vec").alias("n_vec"))
    graph = build_graph(nodes)
    parts = parts_of(graph)
    query_rows = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vec")
    query_rows = stage(query_rows.join(by_vector, F.col("vec") == F.col("n_vec")).select("query_id", "node"), "query_rows")
    asked = query_rows.select("node").distinct().join(graph.select("id", "packed"), F.col("node") == F.col("id"))
    asked = stage(asked.select(F.col("node").alias("query"), "node", F.col("packed").alias("q_packed")), "asked")
    number, total = asked.count(), graph.count()
    links, hubs = links_of(graph, parts)

    probes = stage(asked.orderBy(F.xxhash64("query", F.lit(SEED + 1)), "query").limit(PROBES), "probes")
    truth = true_neighbours(nodes, probes.join(nodes.withColumnRenamed("vec", "q_vec"), F.col("node") == F.col("id")), k)
    few = number <= QUERIES  # then all are searched at once, else the probes first
    found = search(links, hubs, parts, asked if few else probes, BEAM)
    recall = probe_recall(found, truth)
    log.info("%d nodes, beam %d: probe recall %.4f", total, BEAM, recall)
    beam = fitted_beam(total, recall, lambda size: probe_recall(search(links, hubs, parts, probes, size), truth))
    if beam > BEAM:
        log.info("beam %d", beam)
    if not few or beam > BEAM:
        blocks = max(1, -(-number * beam // (max(QUERIES, total // PART) * BEAM)))
        of = F.pmod(F.xxhash64("query", F.lit(SEED)), F.lit(blocks))
        found = reduce(DataFrame.unionByName, [search(links, hubs, parts, asked.where(of == n), beam) for n in range(blocks)])
    links.unpersist()
    top = found.select("query", F.explode("ids").alias("node"))
    pairs = (top.join(nodes.select(F.col("id").alias("q_id"), F.col("vec").alias("q_vec")), F.col("query") == F.col("q_id"))
             .join(nodes, F.col("node") == F.col("id")).select("query", "node", "q_vec", "vec"))
    scored = pairs.mapInArrow(cosine, "query long, node long, score double")
    each = copies.select("vec_id", "vec").join(by_vector, F.col("vec") == F.col("n_vec")).select("vec_id", F.col("node").alias("of"))
    # one more than asked for, since a query's own row is among them
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "node")
    best = (scored.join(each, F.col("node") == F.col("of")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
            .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "node", "score"))).alias("best")))
    others = F.filter("best", lambda x: (x["vec_id"] != F.col("query_id")) | (x["node"] != F.col("node")))
    ranked = (query_rows.join(best, F.col("node") == F.col("query"))
              .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "x")))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
