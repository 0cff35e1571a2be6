"""Ranked lexical search: best-first document intervals under range-maximum bounds.

Documents are indexed in blocks. A block holds, for each term, its posting
list (places of documents in the block, ascending) and, when it is searched, a
sparse table over the list's impacts that answers range-maximum queries in
constant time. A search keeps intervals of document places. The maxima of an
item's posting lists over an interval, summed, bound the score of every document in it.
The intervals with the highest bounds are split at the document of highest
impact: that document is scored exactly, and the intervals left and right of it get
their own bounds. An interval whose bound cannot reach the 20th best score (at
an equal bound: whose smallest doc_id is larger) is done. That is exact. A task carries its best 20 of
each item from block to block, so later blocks end early, and Spark ranks
what the tasks found. Intervals are split a few dozen at a time, so numpy works on arrays.

Inside a block documents are placed by their most frequent indexed term and
their length: documents of one language and size stand together, which keeps
the bounds of intervals tight. The order has no effect on results.

Terms are maximal runs of ASCII letters, digits and all characters beyond
ASCII, only A-Z lower-cased (bytes of UTF-8 give the same runs). The score is the
integer formula at ``impacts`` and ``weight``; N, L and document frequencies are counted by
Spark over all documents. Only terms that some item holds are stored, since no
other term can add to a score; lengths and counts are those of whole texts.

Items are taken in groups of some ``ITEM_BYTES`` of text: a group's terms and items go to
every task, and each group is one pass over the documents.

Defined cases. Null or empty texts, and items or documents without a term: no
rows, and such documents do not count for N. Repeated documents are each ranked; equal
scores by ascending doc_id, null ids last. Equal items (id and text) are one
item. Empty tables give no rows. Very long texts are counted in pieces of whole terms.
Other columns are not read. Tasks hold one block: ``BLOCK_DOCS`` documents or ``BLOCK_BYTES`` of text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallywise.llm.common import drop_folder, stage, staged

TOP = 20
BLOCK_DOCS, BLOCK_BYTES = 4096, 16 << 20
ITEM_BYTES = 4 << 20
PIECE_BYTES = 1 << 20
#: Intervals split together.
BATCH = 48
_LAST = np.iinfo(np.int64).max

_SCHEMA = ("n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, terms array<string>, "
           "dfs array<long>, places array<int>, counts array<int>")
_ARROW = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("dfs", pa.list_(pa.int64())),
                    ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

#: Bytes of terms, A-Z lower-cased; every other byte is a blank.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def term_counts(text: str) -> Counter:
    """How often each term (UTF-8 bytes) occurs in a whole text."""
    data = text.encode().translate(_BYTES)
    if len(data) <= PIECE_BYTES:
        return Counter(data.split())
    counts: Counter = Counter()
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE_BYTES)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


# ------------------------------------------------------------------- index

class _Block:
    """Documents gathered for one row of the index."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        self.docs: list[tuple] = []  # most frequent term, length, id is null, id, terms, counts
        self.n_docs = self.n_terms = self.size = 0

    def add(self, doc_id: int | None, text: str) -> None:
        counts = term_counts(text)
        self.size += len(text)
        length = counts.total()
        if not length:
            return
        self.n_docs += 1
        self.n_terms += length
        get = self.vocabulary.get
        held = [(t, n) for t, n in ((get(w), n) for w, n in counts.items()) if t is not None]
        if held:
            terms, times = np.array(held, dtype=np.int64).T
            self.docs.append((terms[times.argmax()], length, doc_id is None, doc_id or 0, terms.astype(np.int32), times))

    def row(self, names: list[str]) -> dict:
        self.docs.sort(key=lambda d: d[:4])
        sizes = [len(d[4]) for d in self.docs]
        terms = np.concatenate([d[4] for d in self.docs]) if self.docs else np.empty(0, np.int32)
        times = np.concatenate([d[5] for d in self.docs]) if self.docs else np.empty(0, np.int64)
        order = np.argsort(terms, kind="stable")  # by term, then place
        present, dfs = np.unique(terms, return_counts=True)
        return {"n_docs": self.n_docs, "n_terms": self.n_terms, "doc_ids": [None if d[2] else d[3] for d in self.docs],
                "lengths": [d[1] for d in self.docs], "terms": [names[t] for t in present], "dfs": dfs,
                "places": np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order], "counts": times[order].astype(np.int32)}


def index_blocks(docs: DataFrame, terms: list[str]) -> DataFrame:
    """The index of ``docs`` (doc_id, text) for ``terms``, one row a block."""
    vocabulary = {t.encode(): n for n, t in enumerate(terms)}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(vocabulary)

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([block.row(terms)], _ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, text.as_py() or "")
                if len(block.docs) >= BLOCK_DOCS or block.size >= BLOCK_BYTES:
                    yield flush()
                    block = _Block(vocabulary)
        if block.n_docs:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, _SCHEMA)


# ------------------------------------------------------------------ search

def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, times: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Each posting's share of a score: w * ((1000000000 * tf) div (1000 * tf + 12 * m))."""
    m = 100 - 25 + (25 * lengths * n_docs) // n_terms
    return weights * ((1_000_000_000 * times) // (1000 * times + 12 * m))


def range_table(values: np.ndarray, longest: int, better) -> np.ndarray:
    """Sparse table: row k holds at i the place of the best of values[i : i + 2**k]."""
    table = [np.arange(len(values), dtype=np.int32)]
    span = 1
    while 2 * span <= longest:
        last = table[-1]
        left, right = last[:-span], last[span:]
        row = last.copy()
        row[:-span] = np.where(better(values[left], values[right]), left, right)
        table.append(row)
        span *= 2
    return np.stack(table)


class SearchBlock:
    """A block of the index ready for searches: impacts and the tables over them."""

    def __init__(self, doc_ids, lengths, terms, dfs, places, times, weights: dict[str, int], n_docs: int, n_terms: int):
        self.ids = np.array([_LAST if d is None else d for d in doc_ids], dtype=np.int64)
        self.null = np.array([d is None for d in doc_ids], dtype=bool)
        self.n = len(self.ids)
        self.places = np.asarray(places, dtype=np.int64)
        self.ends = np.cumsum(dfs)
        self.starts = self.ends - dfs
        self.at = {t: k for k, t in enumerate(terms)}
        w = np.repeat(np.array([weights[t] for t in terms], dtype=np.int64), dfs)
        self.impact = impacts(w, np.asarray(times, dtype=np.int64), np.asarray(lengths, dtype=np.int64)[self.places], n_docs, n_terms)
        self.keys = np.repeat(np.arange(len(terms), dtype=np.int64), dfs) * self.n + self.places
        self.highest = range_table(self.impact, int(max(dfs, default=1)), np.greater_equal)
        self.smallest = range_table(self.ids, self.n, np.less_equal)
        self.log = np.zeros(max(self.n, len(self.places)) + 2, dtype=np.int64)
        for k in range(1, 63):
            if 1 << k < len(self.log):
                self.log[1 << k:] = k

    def _best(self, table: np.ndarray, values: np.ndarray, lo: np.ndarray, hi: np.ndarray, better) -> np.ndarray:
        """Places of the best values of [lo, hi), which must not be empty."""
        k = self.log[hi - lo]
        left, right = table[k, lo], table[k, hi - (1 << k)]
        return np.where(better(values[left], values[right]), left, right)

    def _bounds(self, lo, hi, times):
        """Summed range maxima of each interval, and the place of its document of highest impact."""
        some = hi > lo
        lo, hi = np.where(some, lo, 0), np.where(some, hi, 1)
        top = self._best(self.highest, self.impact, lo, hi, np.greater_equal)
        found = np.where(some, self.impact[top] * times, 0)
        which = found.argmax(axis=1)
        return found.sum(axis=1), self.places[top[np.arange(len(top)), which]]

    def search(self, item: list[tuple[str, int]], best: "Best") -> int:
        """Offer the block's documents that can be among the best; how many were scored."""
        held = [(self.at[t], n) for t, n in item if t in self.at]
        if not held:
            return 0
        terms, times = np.array(held, dtype=np.int64).T
        base = terms * self.n
        lo, hi = self.starts[terms][None, :], self.ends[terms][None, :]
        first, last = np.array([0]), np.array([self.n])
        bound, split = self._bounds(lo, hi, times)
        scored = 0
        while True:
            open_ = np.flatnonzero(self._open(bound, first, last, best))
            if not len(open_):
                return scored
            if len(open_) > BATCH:
                now = open_[np.argpartition(-bound[open_], BATCH)[:BATCH]]
                rest = np.setdiff1d(open_, now, assume_unique=True)
            else:
                now, rest = open_, open_[:0]
            doc, a, b = split[now], lo[now], hi[now]
            at = np.searchsorted(self.keys, base + doc[:, None])
            at = np.minimum(np.maximum(at, a), b)
            inside = np.minimum(at, len(self.places) - 1)
            here = (at < b) & (self.places[inside] == doc[:, None])
            scored += len(now)
            best.offer(np.where(here, self.impact[inside] * times, 0).sum(axis=1), self.ids[doc], self.null[doc])
            new_lo, new_hi = np.concatenate([a, at + here]), np.concatenate([at, b])
            new_first, new_last = np.concatenate([first[now], doc + 1]), np.concatenate([doc, last[now]])
            new_bound, new_split = self._bounds(new_lo, new_hi, times)
            fit = new_bound > 0
            lo, hi = np.concatenate([lo[rest], new_lo[fit]]), np.concatenate([hi[rest], new_hi[fit]])
            first, last = np.concatenate([first[rest], new_first[fit]]), np.concatenate([last[rest], new_last[fit]])
            bound, split = np.concatenate([bound[rest], new_bound[fit]]), np.concatenate([split[rest], new_split[fit]])

    def _open(self, bound, first, last, best: "Best") -> np.ndarray:
        score, doc_id = best.least()
        may = bound > score
        tied = np.flatnonzero((bound == score) & (bound > 0))
        if len(tied):
            least = self.ids[self._best(self.smallest, self.ids, first[tied], last[tied], np.less_equal)]
            may[tied] = least <= doc_id
        return may


class Best:
    """The best ``TOP`` documents of an item: highest score, then smallest id, null ids last."""

    def __init__(self):
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    def offer(self, scores, ids, null) -> None:
        scores, ids, null = (np.concatenate(p) for p in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        order = np.lexsort((null, ids, -scores))[:TOP]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]

    def least(self) -> tuple[int, int]:
        """The last score and id that a further document has to reach; (0, last id) while there is room."""
        return (int(self.scores[-1]), int(self.ids[-1])) if len(self.scores) == TOP else (0, _LAST)


def search_blocks(blocks: DataFrame, items: list[tuple[int | None, dict[str, int]]], weights: dict[str, int],
                  n_docs: int, n_terms: int) -> DataFrame:
    """item (place in ``items``), score, doc_id: the best of each task."""
    asked = [sorted(terms.items()) for _, terms in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best() for _ in asked]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].values for name in ("doc_ids", "lengths", "terms", "dfs", "places", "counts")}
                if not len(row["places"]):
                    continue
                block = SearchBlock(row["doc_ids"].to_pylist(), row["lengths"].to_numpy(), row["terms"].to_pylist(),
                                    row["dfs"].to_numpy(), row["places"].to_numpy(), row["counts"].to_numpy(),
                                    weights, n_docs, n_terms)
                for terms, found in zip(asked, best):
                    block.search(terms, found)
        sizes = [len(b.scores) for b in best]
        if sum(sizes):
            ids = pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.null for b in best]))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(best)), sizes)),
                                              pa.array(np.concatenate([b.scores for b in best])), ids], ["item", "score", "doc_id"])

    return blocks.mapInArrow(run, "item long, score long, doc_id long")


def _groups(items: DataFrame) -> Iterator[list[tuple[int | None, dict[str, int]]]]:
    """The items with their term counts, in groups of about ``ITEM_BYTES`` of text."""
    items = items.select(F.col("item_id").cast("long"), "text").filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // ITEM_BYTES))
    for group in range(groups):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group)
        yield [(r.item_id, {t.decode(): n for t, n in term_counts(r.text).items()}) for r in mine.toLocalIterator()]


def rank_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``TOP`` best documents."""
    spark = docs.sparkSession
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for group in _groups(items):
        terms = sorted({t for _, held in group for t in held})
        if not terms:
            continue
        blocks, folder = staged(index_blocks(docs, terms), "postings")
        n_docs, n_terms = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if n_docs:
            dfs = (blocks.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).groupBy("t.terms").agg(F.sum("t.dfs").alias("df")))
            weights = {r.terms: weight(n_docs, r.df) for r in dfs.toLocalIterator()}
            found = search_blocks(blocks, group, weights, n_docs, n_terms)
            order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
            ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
            ids = spark.createDataFrame([(n, item_id) for n, (item_id, _) in enumerate(group)], "item long, item_id long")
            ranked = stage(ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
            result = result.unionByName(ranked)
        drop_folder(spark, folder)
    return result


#: The same ranking in DuckDB.
RANK_SQL = r"""
with d as (
  select row_number() over () as doc, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents where text is not null),
posting as (select doc, any_value(doc_id) as doc_id, term, count(*) as tf from d group by doc, term),
length as (select doc, sum(tf) as n from posting group by doc),
total as (select count(*) as nd, sum(n) as nl from length),
word as (select term, cast(floor(1000 * ln((2 * max(nd) + 2) / (2 * count(*) + 1))) as bigint) as w from posting, total group by term),
item as (
  select item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from (select distinct item_id, text from benchmark where text is not null)),
asked as (select item_id, text, term, count(*) as times from item group by all),
scored as (
  select a.item_id, a.text, p.doc, any_value(p.doc_id) as doc_id,
    sum(cast(a.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (100 - 25 + cast((25 * l.n * t.nd) // t.nl as bigint)))) as bigint)) as score
  from asked a join posting p using (term) join word w using (term) join length l using (doc), total t group by all),
ranked as (
  select item_id, cast(row_number() over (partition by item_id, text order by score desc, doc_id asc nulls last) as integer) as rank,
    doc_id, cast(score as bigint) as score from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""
