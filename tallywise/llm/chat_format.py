"""Chat formatting by token-level assembly.

Each turn's role and text are encoded as separate segments, and reserved ids
are spliced around them: TURN role SPEAKS text DONE. Content is encoded as
ordinary text, so it never yields a reserved id. In the rendered form the
reserved ids read ``### ``, a line feed, and ``</turn>`` with a line feed;
these control strings are escaped with a backslash where they occur in
content, as are backslashes, and unescaping reverses it. The loss mask marks the
ids of assistant texts: each segment adds +1 where it begins and -1 where it ends,
and the mask is the prefix sum.

Turns are encoded wherever they lie; then a conversation's turns go, in order,
through one task that packs them into chunks and holds one chunk at a time, so
a conversation of any length needs bounded memory. Chunks are written to the
shared folder and read back for the digests.

Defined cases: null texts and roles are empty; null turns come last; equal
turns are ordered by role and text hash; a null conversation id is a conversation;
repeated rows are turns of their own; empty input gives empty output.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm.common import stage

CHUNK_IDS = 1 << 15
# Reserved ids above the vocabulary, and what they read.
TURN, SPEAKS, DONE = 50257, 50258, 50259
SHOWN = {TURN: "### ", SPEAKS: "\n", DONE: "</turn>\n"}
CONTROL = ("###", "</turn>")
LOSS_ROLE = "assistant"

_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_UNESCAPE = re.compile(r"\\(\\|" + "|".join(map(re.escape, CONTROL)) + ")")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


_LOADED: dict = {}


def tokenizer(path: str):
    """The rank file's encoding, read once per worker process."""
    if path not in _LOADED:
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as fh:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
        _LOADED[path] = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def rank_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


# Fixed value: Unicode white space, as the tokenizer's pattern sees it.
_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}")
#: Longer runs of white space are cut out before the tokenizer's pattern sees them: its matcher recurses on them.
LONG_RUN = 1 << 14


def encode_text(enc, text: str) -> list[int]:
    """The ids of a whole text. A run of white space is one pre-token but for its last character, which goes
    with what follows; a long run is encoded as that pre-token, and the rest on either side of it as ever."""
    if len(text) < LONG_RUN:
        return enc.encode_ordinary(text)
    ids, at = [], 0
    for m in _WHITE.finditer(text):
        if m.end() - m.start() >= LONG_RUN:
            end = m.end() - (m.end() < len(text))
            ids += enc.encode_ordinary(text[at:m.start()])
            ids += enc._encode_single_piece(text[m.start():end].encode())
            at = end
    return ids + enc.encode_ordinary(text[at:])


def assemble(enc, role: str, text: str) -> tuple[list[int], list[int]]:
    """A turn's ids, and where its loss begins and ends (no places: no loss)."""
    who, what = encode_text(enc, escape(role)), encode_text(enc, escape(text))
    ids = [TURN, *who, SPEAKS, *what, DONE]
    return ids, [len(who) + 2, len(who) + 2 + len(what)] if role == LOSS_ROLE else []


def loss_mask(n: int, begins: list[int], ends: list[int]) -> bytes:
    """One byte for each id: 1 where it is trained on."""
    steps = np.zeros(n + 1, np.int8)
    np.add.at(steps, begins, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n], dtype=np.int8).tobytes()


def format_chats(turns: DataFrame, path: str, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """Chunks of formatted conversations: conv_id, chunk, ids, loss (a byte for each id)."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                        F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    keep = ["conv_id", "turn", "role", "tie"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def encode(batches):
        for b in batches:
            enc = tokenizer(path)
            made = [assemble(enc, r or "", t or "") for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array([m[0] for m in made], pa.list_(pa.int32())),
                                               pa.array([m[1] for m in made], pa.list_(pa.int32()))], [*keep, "ids", "loss"])

    encoded = rows.mapInArrow(encode, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", ids array<int>, loss array<int>")
    ordered = (encoded.repartition("conv_id")
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "tie")
               .select("conv_id", "ids", "loss"))
    return ordered.mapInArrow(_pack, f"conv_id {kinds['conv_id']}, chunk long, ids array<int>, loss binary")


def _pack(batches):
    """Consecutive turns of a conversation as chunks of about CHUNK_IDS ids, cut between turns."""
    state = {"conv": None, "chunk": 0, "ids": [], "n": 0, "begins": [], "ends": []}
    names = ["conv_id", "chunk", "ids", "loss"]

    def close(out):
        if state["n"]:
            ids = np.concatenate(state["ids"])
            out.append((state["conv"], state["chunk"], ids, loss_mask(state["n"], state["begins"], state["ends"])))
            state.update(chunk=state["chunk"] + 1, ids=[], n=0, begins=[], ends=[])

    def batch_of(out, kind):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], kind), pa.array([r[1] for r in out], pa.int64()),
                                           pa.array([r[2] for r in out], pa.list_(pa.int32())),
                                           pa.array([r[3] for r in out], pa.binary())], names)

    kind, first = None, True
    for b in batches:
        kind, out = b.column("conv_id").type, []
        lists = b.column("ids")
        values, at = lists.values.to_numpy(), lists.offsets.to_numpy()
        for k, (conv, loss) in enumerate(zip(b.column("conv_id").to_pylist(), b.column("loss").to_pylist())):
            if first or conv != state["conv"]:
                close(out)
                state.update(conv=conv, chunk=0)
                first = False
            ids = values[at[k]:at[k + 1]].copy()
            if loss:
                state["begins"].append(state["n"] + loss[0])
                state["ends"].append(state["n"] + loss[1])
            state["ids"].append(ids)
            state["n"] += len(ids)
            if state["n"] >= CHUNK_IDS:
                close(out)
        yield batch_of(out, kind)
    if state["n"]:
        out = []
        close(out)
        yield batch_of(out, kind)


def read_chunk(enc, ids: np.ndarray, loss: bytes) -> tuple[list[tuple[str, str]], list[str], int]:
    """Turns (role, text) of a chunk, the texts under its loss mask, and its rendered length."""
    marks = np.flatnonzero(ids >= TURN)
    turns, trained, shown = [], [], 0
    mask = np.frombuffer(loss, np.int8)
    for a, b, c in zip(marks[0::3], marks[1::3], marks[2::3]):
        if (ids[a], ids[b], ids[c]) != (TURN, SPEAKS, DONE):
            raise ValueError("reserved ids out of order")
        who, what = (enc.decode_bytes(ids[x + 1:y].tolist()).decode() for x, y in ((a, b), (b, c)))
        shown += sum(len(SHOWN[k]) for k in (TURN, SPEAKS, DONE)) + len(who) + len(what)
        turns.append((unescape(who), unescape(what)))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
    for a, b in zip(edges[0::2], edges[1::2]):
        trained.append(unescape(enc.decode_bytes(ids[a:b].tolist()).decode()))
    return turns, trained, shown


def chat_digests(chunks: DataFrame, path: str) -> DataFrame:
    """Counts and digests of each conversation, from its chunks."""
    kind = chunks.schema["conv_id"].dataType.simpleString()

    def read(batches):
        for b in batches:
            enc, rows = tokenizer(path), []
            for ids, loss in zip(b.column("ids"), b.column("loss").to_pylist()):
                turns, trained, shown = read_chunk(enc, ids.values.to_numpy(), loss)
                said = "".join(f"{r}\n{t}\n" for r, t in turns).encode()
                under = "".join(trained)
                rows.append((len(turns), said, len(under), under.encode(), shown))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("chunk"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.int64())],
                ["conv_id", "chunk", "n", "said", "chars", "under", "shown"])

    made = chunks.mapInArrow(read, f"conv_id {kind}, chunk long, n long, said binary, chars long, under binary, shown long")
    return (made.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
            .mapInArrow(_digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long"))


def _digest(batches):
    """Running digests over a conversation's chunks; nothing of it is held."""
    conv, now, kind, first = None, None, None, True
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def batch_of(out):
        rows = [(c, x[0], x[1].hexdigest(), x[2], x[3].hexdigest(), x[4]) for c, x in out]
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    for b in batches:
        kind, out = b.column("conv_id").type, []
        for c, n, said, chars, under, shown in zip(*(b.column(x).to_pylist() for x in ("conv_id", "n", "said", "chars", "under", "shown"))):
            if first or c != conv:
                if not first:
                    out.append((conv, now))
                conv, now, first = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0], False
            now[0] += n
            now[1].update(said)
            now[2] += chars
            now[3].update(under)
            now[4] += shown
        yield batch_of(out)
    if not first:
        yield batch_of([(conv, now)])


def formatted(turns: DataFrame) -> DataFrame:
    """Format, write, read back and digest."""
    path = rank_path()
    return chat_digests(stage(format_chats(turns, path), "chats"), path)
