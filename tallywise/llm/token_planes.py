"""Token-ID output in files of byte planes.

Texts are encoded with the tokenizers library, an end id is appended to each
document, and the ids are written in ascending document order. A file holds
whole documents: their ids in blocks of ``BLOCK`` ids, each block's 32-bit ids
transposed into four byte planes that are compressed one by one, a chunk index
with every plane's length, and a table of the documents.

Layout (little-endian): magic, then eight 64-bit numbers (ids of the partition before this
file, documents, ids, block length, chunks, bytes of document table, of chunk index, of
planes), the zstandard-compressed document table (ids, null flags, lengths), the
compressed chunk index (ids and four plane lengths per chunk), and the planes.

The library's normalizers and pre-tokenizer never join what ASCII white space
parts, so texts are cut there and the library encodes each distinct piece
once; a worker remembers two generations of pieces, each bounded in bytes.

Files are written under the shared folder under a name of their own and then
renamed, and only files listed in the written manifest are read, so a task
that runs again replaces its files.

Defined cases: null and empty texts hold the end id only; null ids come first; rows with equal
ids keep their own entries; an empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywise.llm.common import stage
from tallywise.session import scratch_path

MAGIC = b"TWPLANE1"
BLOCK = 1 << 16
FILE_IDS = 1 << 21     # a file is closed once it has so many ids
END_ID = 1
LEVEL = 3
MEMO_BYTES = 48 << 20  # a generation of remembered pieces, in bytes; a worker holds two
ENTRY_BYTES = 180      # what an entry costs beside its characters and ids
PIECES = 20_000        # pieces in one library call
# Latin letters that stay letters when lowered and normalized (U+0130 does not), then ASCII signs but for the apostrophe.
SIGNED = "^(?P<letters>[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)(?P<signs>[!-&(-/:-@\\[-`{-~]+)$"
SLICE = 1 << 22        # characters of texts encoded together

_LOADED: dict = {}


class PieceEncoder:
    """The library's encoding of pieces without ASCII white space; one per worker process.

    A piece of letters and then ASCII signs is two pieces to the library, whose pre-tokenizer cuts there, and ASCII
    letters are lower-cased by its normalizer; so signs are cut off and letters lowered first, which leaves
    it fewer pieces to encode. Pieces that could hold a special token's string are sent as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.memo: dict[str, bytes] = {}
        self.past: dict[str, bytes] = {}
        self.held = 0

    def known(self, pieces: list[str]) -> pa.Array:
        """The ids of distinct pieces as bytes, remembered or encoded now."""
        memo, past = self.memo, self.past
        found = list(map(memo.get, pieces))
        fresh = []
        for k in [k for k, ids in enumerate(found) if ids is None]:
            p = pieces[k]
            ids = past.get(p)
            if ids is None:
                fresh.append(k)
            else:
                memo[p] = found[k] = ids
                self.held += len(p) + len(ids) + ENTRY_BYTES
        for at in range(0, len(fresh), PIECES):
            part = fresh[at:at + PIECES]
            for k, e in zip(part, self.library.encode_batch_fast([pieces[k] for k in part], add_special_tokens=False)):
                ids = memo[pieces[k]] = found[k] = array("I", e.ids).tobytes()
                self.held += len(pieces[k]) + len(ids) + ENTRY_BYTES
        made = pa.array(found, pa.large_binary())
        if self.held > MEMO_BYTES:  # pieces in use come back from the generation before, the rest go
            self.past, self.memo, self.held = memo, {}, 0
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers, without an end id."""
        cut = [t.encode().split() for t in texts]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        coded = pa.array([p for own in cut for p in own], pa.binary()).dictionary_encode()
        names = coded.dictionary.cast(pa.string())
        lowered = pc.if_else(pc.match_substring(names, "<|"), names, pc.ascii_lower(names))
        parts = pc.extract_regex(lowered, SIGNED)
        stems = pc.coalesce(pc.struct_field(parts, "letters"), lowered).dictionary_encode()
        signs = pc.struct_field(parts, "signs").dictionary_encode()
        ids = self.known(stems.dictionary.to_pylist()).take(stems.indices)
        after = self.known(signs.dictionary.to_pylist()).take(signs.indices)
        whole = pc.binary_join_element_wise(ids, pc.fill_null(after, b""), pa.scalar(b"", pa.large_binary()))
        made = whole.take(coded.indices)
        raw = memoryview(made.buffers()[2] or b"")
        ends = np.frombuffer(made.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [bytes(raw[a:b]) for a, b in zip(ends, ends[1:])]


def tokenizer(path: str) -> PieceEncoder:
    if path not in _LOADED:
        _LOADED[path] = PieceEncoder(path)
    return _LOADED[path]


def slices(texts: list[str]) -> list[tuple[int, int]]:
    """Runs of texts of about ``SLICE`` characters."""
    out, at, size = [], 0, 0
    for k, t in enumerate(texts):
        if k > at and size + len(t) > SLICE:
            out.append((at, k))
            at, size = k, 0
        size += len(t)
    return [*out, (at, len(texts))] if texts else out


def encode(texts: list[str], path: str) -> list[bytes]:
    made = tokenizer(path)
    return [ids for a, b in slices(texts) for ids in made.encode(texts[a:b])]


# ---------------------------------------------------------------- the file format

def pack_file(base: int, doc_ids: list, ids: list[bytes]) -> bytes:
    """A file of documents; ``base`` counts the ids of its partition before it."""
    press = zstandard.ZstdCompressor(level=LEVEL).compress
    flat = np.frombuffer(b"".join(ids), "<u4")
    index, planes = [], []
    for at in range(0, len(flat), BLOCK):
        block = flat[at:at + BLOCK]
        own = [press(p.tobytes()) for p in block.view(np.uint8).reshape(-1, 4).T]
        index.append([len(block), *map(len, own)])
        planes += own
    none = np.array([d is None for d in doc_ids], "<i8")
    table = press(np.concatenate([np.array([d or 0 for d in doc_ids], "<i8"), none,
                                  np.array([len(b) // 4 for b in ids], "<i8")]).tobytes())
    chunks = press(np.array(index, "<i8").tobytes())
    body = b"".join(planes)
    head = np.array([base, len(doc_ids), len(flat), BLOCK, len(index), len(table), len(chunks), len(body)], "<i8")
    return MAGIC + head.tobytes() + table + chunks + body


def unpack_chunk(data: bytes, lengths: np.ndarray, at: int) -> np.ndarray:
    """One chunk's ids: its planes start at ``at``."""
    expand = zstandard.ZstdDecompressor().decompress
    out = np.empty((int(lengths[0]), 4), np.uint8)
    for k in range(4):
        size = int(lengths[1 + k])
        out[:, k] = np.frombuffer(expand(data[at:at + size]), np.uint8)
        at += size
    return out.reshape(-1).view("<u4")


def unpack_file(data: bytes) -> tuple[int, list, np.ndarray, np.ndarray]:
    """base, document ids, their lengths, and all ids."""
    if data[:8] != MAGIC:
        raise ValueError("not a plane file")
    base, docs, n, _, chunks, table_size, index_size, _ = np.frombuffer(data[8:72], "<i8").tolist()
    expand = zstandard.ZstdDecompressor().decompress
    at = 72
    table = np.frombuffer(expand(data[at:at + table_size]), "<i8").reshape(3, docs)
    index = np.frombuffer(expand(data[at + table_size:at + table_size + index_size]), "<i8").reshape(chunks, 5) if chunks else []
    at += table_size + index_size
    parts = []
    for row in index:
        parts.append(unpack_chunk(data, row, at))
        at += int(row[1:].sum())
    flat = np.concatenate(parts) if parts else np.empty(0, "<u4")
    if len(flat) != n:
        raise ValueError("a plane file is cut short")
    ids = [None if none else d for d, none in zip(table[0].tolist(), table[1].tolist())]
    return base, ids, table[2], flat


# ---------------------------------------------------------------- Spark

def write_planes(docs: DataFrame, path: str, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files; returns the manifest (part, name, n_docs, n_ids), staged."""
    pos = F.monotonically_increasing_id()  # parts repeated ids, so a hot id spreads over tasks
    ordered = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), pos.alias("pos"))
               .repartitionByRange("doc_id", "pos").sortWithinPartitions("doc_id", "pos").select("doc_id", "text"))

    def run(batches):
        from pyarrow import fs
        part = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        state = {"base": 0, "seq": 0, "docs": [], "ids": [], "n": 0}
        end = np.array([END_ID], "<u4").tobytes()

        def close(out):
            if not state["docs"]:
                return
            name = f"part-{part:06d}-{state['seq']:05d}.planes"
            draft = f"{root}/{name}.{uuid.uuid4().hex}.draft"
            with store.open_output_stream(draft) as fh:
                fh.write(pack_file(state["base"], state["docs"], state["ids"]))
            store.move(draft, f"{root}/{name}")
            out.append((part, name, len(state["docs"]), state["n"]))
            state.update(base=state["base"] + state["n"], seq=state["seq"] + 1, docs=[], ids=[], n=0)

        def listed(out):
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)],
                                              ["part", "name", "n_docs", "n_ids"])

        for batch in batches:
            out = []
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            texts = [t or "" for t in texts]
            for at, stop in slices(texts):
                for key, own in zip(keys[at:stop], tokenizer(path).encode(texts[at:stop])):
                    state["docs"].append(key)
                    state["ids"].append(own + end)
                    state["n"] += len(own) // 4 + 1
                    if state["n"] >= FILE_IDS:
                        close(out)
            yield listed(out)
        out = []
        close(out)
        yield listed(out)

    return stage(ordered.mapInArrow(run, "part long, name string, n_docs long, n_ids long"), "manifest")


def read_planes(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the listed files."""
    # one row per writing task, so the window and the broadcast stay small
    totals = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = totals.select(F.col("part").alias("s_part"), (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.planes").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))
    names = manifest.join(F.broadcast(starts), F.col("part") == F.col("s_part")).select("name", "before")
    listed = files.join(names, F.col("file") == F.col("name")).select("before", "content")

    def run(batches):
        for batch in batches:
            for before, data in zip(batch.column("before").to_pylist(), batch.column("content")):
                base, ids, lengths, flat = unpack_file(data.as_py())
                ends = np.cumsum(lengths)
                raw = memoryview(flat.tobytes())
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(before + base + ends - lengths, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def planes_round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write all documents and read them back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, f"llm/planes-{uuid.uuid4().hex}")
    manifest = write_planes(docs, path or vocabulary_path(), folder)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_planes(spark, folder, manifest)
