"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

Texts are cut into pre-tokens as the tokenizer's byte-level pattern does. The
corpus's most frequent pre-tokens (counted over all documents) are compiled,
with the ids that they encode to, into a minimal acyclic automaton: words
share prefixes and suffixes, and numbers summed along a word's path give its
place in the table of id outputs. Its arrays are one block of bytes, which
each worker maps into memory from an unnamed file. A batch's distinct words walk it
together, a byte at a time, in numpy. Words it lacks are merged exactly: short ones
together in numpy, a round for each word's pair of lowest rank, long ones by
rank with a heap, so that a word of any length costs n log n. What a counting task
holds is bounded in bytes, whatever the words' lengths; an encoding task holds a slice of texts.

Decoding turns ids back into bytes through the vocabulary and reads them as
UTF-8 with replacement marks for broken sequences.

Defined cases: null and empty texts have no ids; the special token's string in a text is
the special id, as in the tokenizer; repeated rows get equal results; an empty
corpus has an empty lexicon.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import tempfile
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.llm.common import fresh, pipeline_stage, stage, with_arrow_columns

LEXICON = 65_536       # words in the automaton, at most
WORD_BYTES = 64        # longer words are always merged
HELD_BYTES = 48 << 20  # what a counting task holds, in bytes
ENTRY_BYTES = 120      # what an entry costs beside its characters
SLICE = 1 << 22        # bytes of texts encoded together
BATCH_WORD_BYTES = 48  # words up to this length are merged together

# Fixed value: the byte-level pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Cutting before a single blank that a non-blank follows never cuts a pre-token, nor does it lose one.
CUT = re.compile(r" (?=\S)")


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Vocabulary:
    """Ids, merge ranks and bytes of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        letters = byte_letters()
        model = spec["model"]
        known = {bytes(letters[c] for c in w): i for w, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.decoded = {i: b for b, i in known.items()}
        self.decoded.update({i: s.encode() for s, i in self.special.items()})
        self.byte_id = [known[bytes([b])] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            a, b = (bytes(letters[c] for c in x) for x in (a, b))
            self.merges[known[a], known[b]] = (rank, known[a + b])
        pairs = sorted((a << 32 | b, rank, made) for (a, b), (rank, made) in self.merges.items())
        self.pair_keys, self.pair_ranks, self.pair_made = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ((), (), ())))
        self.byte_ids = np.array(self.byte_id, np.int64)
        size = max(self.decoded) + 1
        self.raw = pa.array([self.decoded.get(i, b"") for i in range(size)], pa.large_binary())
        self.decimal = pa.array([b"%d," % i for i in range(size)], pa.large_binary())
        self.split = regex.compile(PATTERN).findall
        names = sorted(self.special, key=len, reverse=True)
        self.special_split = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def units(self, text: str) -> list[str]:
        """Units of a text that may hold special tokens; these are units of their own."""
        if self.special_split is None or not any(s in text for s in self.special):
            return units(text) if text else []
        out = []
        for k, part in enumerate(self.special_split.split(text)):
            out += [part] if k % 2 else units(part) if part else []
        return out

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token: always the pair of lowest rank, the leftmost of equals."""
        ids = [self.byte_id[b] for b in word]
        n, get = len(ids), self.merges.get
        if n < 2:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], k, m[1], ids[k], ids[k + 1]) for k in range(n - 1) if (m := get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, made, a, b = heapq.heappop(heap)
            j = after[k]
            if ids[k] != a or j >= n or ids[j] != b:
                continue  # one side has been merged since
            ids[k], ids[j] = made, -1
            after[k] = j = after[j]
            if j < n:
                before[j] = k
                if m := get((made, ids[j])):
                    heapq.heappush(heap, (m[0], k, m[1], made, ids[j]))
            if (i := before[k]) >= 0 and (m := get((ids[i], made))):
                heapq.heappush(heap, (m[0], i, m[1], ids[i], made))
        return [i for i in ids if i >= 0]

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; rank NO_RANK where it never merges."""
        if not len(self.pair_keys):
            return np.full(len(left), NO_RANK), np.zeros(len(left), np.int64)
        key = left << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK), self.pair_made[at]

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """The ids of non-empty pre-tokens as 32-bit integers. Each round merges, in every word, all places of its pair of
        lowest rank, from the left; a pair with the merged piece has a higher rank, so this is the order of ``merge``."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for k in np.flatnonzero(lengths > BATCH_WORD_BYTES).tolist():
            out[k] = np.array(self.merge(words[k]), np.int32).tobytes()
        live = np.flatnonzero((lengths > 0) & (lengths <= BATCH_WORD_BYTES))
        if not len(live):
            return out
        ids = self.byte_ids[np.frombuffer(b"".join([words[k] for k in live.tolist()]), np.uint8)]
        sizes = lengths[live]
        first = np.cumsum(sizes) - sizes

        def pairs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return self._ranked(ids[at], ids[np.minimum(at + 1, len(ids) - 1)])

        rank, made = pairs(np.arange(len(ids)))
        rank[first + sizes - 1] = NO_RANK  # no pair over a word's end
        while True:
            least = np.minimum.reduceat(rank, first)
            done = least == NO_RANK
            if done.any():
                ended = np.repeat(done, sizes)
                raw, at = ids[ended].astype(np.int32).tobytes(), 0
                for k, n in zip(live[done].tolist(), sizes[done].tolist()):
                    out[k] = raw[at:at + 4 * n]
                    at += 4 * n
                live, sizes, least = live[~done], sizes[~done], least[~done]
                if not len(live):
                    return out
                ids, rank, made = ids[~ended], rank[~ended], made[~ended]
                first = np.cumsum(sizes) - sizes
            hit = rank == np.repeat(least, sizes)
            at = np.flatnonzero(hit)
            begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)  # of runs such as "aaa": every second place merges
            at = at[(np.arange(len(at)) - np.repeat(begins, np.diff(begins, append=len(at)))) % 2 == 0]
            ids[at] = made[at]
            gone = np.zeros(len(ids), bool)
            gone[at + 1] = True
            sizes = sizes - np.add.reduceat(gone, first)
            place = np.cumsum(~gone) - 1
            ids, rank, made = ids[~gone], rank[~gone], made[~gone]
            first = np.cumsum(sizes) - sizes
            ends = np.zeros(len(ids), bool)
            ends[first + sizes - 1] = True
            begin = np.zeros(len(ids), bool)
            begin[first] = True
            now = place[at]
            anew = np.zeros(len(ids), bool)
            anew[now] = True
            anew[now[~begin[now]] - 1] = True
            anew = np.flatnonzero(anew & ~ends)
            rank[anew], made[anew] = pairs(anew)
            rank[first + sizes - 1] = NO_RANK


#: The rank of a pair that never merges.
NO_RANK = np.iinfo(np.int64).max


# ---------------------------------------------------------------- the automaton

def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> bytes:
    """The minimal acyclic transducer of sorted, distinct ``words`` as one block of bytes.

    States are made from the end: when the next word leaves a branch, its
    states are final and each is replaced by an equal earlier one, if there is
    one. A state's edges carry how many words sort before those beyond the
    edge, so the sum along a word is its place."""
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    counts: list[int] = []
    edges: list[list[tuple[int, int]]] = []
    path: list[tuple[bool, list[tuple[int, int]]]] = [[False, []]]

    def close(state) -> int:
        key = (state[0], tuple(state[1]))
        got = register.get(key)
        if got is None:
            got = register[key] = len(finals)
            finals.append(state[0])
            edges.append(state[1])
            counts.append(state[0] + sum(counts[t] for _, t in state[1]))
        return got

    last = b""
    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            state = path.pop()
            path[-1][1].append((last[len(path) - 1], close(state)))
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        state = path.pop()
        path[-1][1].append((last[len(path) - 1], close(state)))
    root = close(path[0])
    keys, to, skip = [], [], []
    for s, own in enumerate(edges):
        passed = int(finals[s])
        for byte, t in own:
            keys.append(s << 8 | byte)
            to.append(t)
            skip.append(passed)
            passed += counts[t]
    parts = [np.array(keys, np.int64), np.array(to, np.int64), np.array(skip, np.int64), np.array(finals, np.int64),
             np.cumsum([0, *map(len, ids)]).astype(np.int64), np.array([i for x in ids for i in x], np.int64)]
    head = np.array([root, *map(len, parts)], np.int64)
    return head.tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """The automaton over a block of bytes that is mapped into memory."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as fh:  # the mapping outlives the unnamed file's handle
            fh.write(block)
            fh.flush()
            self.map = mmap.mmap(fh.fileno(), 0, access=mmap.ACCESS_READ)
        data = np.frombuffer(self.map, np.int64)
        self.root, sizes = int(data[0]), data[1:7]
        ends = 7 + np.cumsum(sizes)
        self.keys, self.to, self.skip, self.finals, self.starts, self.ids = (
            data[e - n:e] for e, n in zip(ends, sizes))

    def places(self, words: list[bytes]) -> np.ndarray:
        """Each word's place among the lexicon's words, -1 for those it lacks."""
        n = len(words)
        out = np.full(n, -1)
        if not n or not len(self.keys):
            return out
        lengths = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words) or b"\0", np.uint8)
        begin = np.cumsum(lengths) - lengths
        live = np.flatnonzero((lengths > 0) & (lengths <= WORD_BYTES))
        state, place = np.full(len(live), self.root), np.zeros(len(live), np.int64)
        depth = 0
        while len(live):
            ended = lengths[live] == depth
            if ended.any():
                good = ended & (self.finals[state] == 1)
                out[live[good]] = place[good]
                live, state, place = live[~ended], state[~ended], place[~ended]
                if not len(live):
                    break
            key = state << 8 | flat[begin[live] + depth]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == key
            live, at = live[hit], at[hit]
            state, place = self.to[at], place[hit] + self.skip[at]
            depth += 1
        return out

    def output(self, place: int) -> list[int]:
        return self.ids[self.starts[place]:self.starts[place + 1]].tolist()


# ---------------------------------------------------------------- counting

def units(text: str) -> list[str]:
    """The text cut before each single blank that a non-blank follows; all but the first begin with it."""
    first, *rest = CUT.split(text)
    return [first, *(" " + r for r in rest)] if first else [" " + r for r in rest]


class Cut:
    """Texts cut into units: the distinct ones, and for each text their places.

    Arrow splits at every blank; texts in which a blank is followed by white space
    or by nothing, or which hold a special token, are cut again one by one."""

    def __init__(self, texts: pa.Array, vocab):
        pieces = pc.split_pattern(texts, " ")
        offsets = pieces.offsets.to_numpy().astype(np.int64)
        coded = pieces.values.dictionary_encode()
        codes, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        codes, offsets = codes[offsets[0]:offsets[-1]], offsets - offsets[0]
        first = offsets[:-1]
        odd = np.fromiter((not p or p[0].isspace() for p in names), bool, len(names))[codes]
        odd[first] = False
        total = np.concatenate([[0], np.cumsum(odd)])
        again = total[offsets[1:]] > total[offsets[:-1]]
        for word in vocab.special:
            again |= pc.match_substring(texts, word).to_numpy(zero_copy_only=False)
        begins, place = np.unique(codes[first], return_inverse=True)
        self.units = [" " + p for p in names] + [names[k] for k in begins]
        codes[first] = len(names) + place
        if again.any():
            index = {u: k for k, u in enumerate(self.units)}
            parts, sizes = [], np.diff(offsets)
            for k in range(len(again)):
                if again[k]:
                    own = np.array([index.setdefault(u, len(index)) for u in vocab.units(texts[k].as_py())], np.int64)
                    sizes[k] = len(own)
                    parts.append(own)
                else:
                    parts.append(codes[offsets[k]:offsets[k + 1]])
            self.units = list(index)
            codes, offsets = np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])
        self.codes, self.offsets = codes, offsets


def slices(texts: pa.Array):
    """The texts in runs of about SLICE bytes."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    at, room = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if k > at and room + n > SLICE:
            yield texts.slice(at, k - at)
            at, room = k, 0
        room += n
    if at < len(sizes):
        yield texts.slice(at)


def count_words(docs: DataFrame, text: str, vocabulary) -> DataFrame:
    """Every pre-token of the corpus with its number, summed in each task before it moves."""
    def run(batches):
        vocab, seen, held = vocabulary(), Counter(), 0

        def out():
            own = Counter()
            for unit, n in seen.items():
                if unit not in vocab.special:
                    for w in vocab.split(unit):
                        own[w] += n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(own.keys(), pa.string()), pa.array(own.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in slices(batch.column(0).fill_null("")):
                cut = Cut(part, vocab)
                often = np.bincount(cut.codes, minlength=len(cut.units)).tolist()
                for u, n in zip(cut.units, often):
                    if n:
                        if u not in seen:
                            held += len(u) + ENTRY_BYTES
                        seen[u] += n
                if held > HELD_BYTES:
                    held = 0
                    yield out()
        yield out()

    made = docs.select(F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, text: str, vocabulary, most: int = LEXICON) -> list[str]:
    """The words whose count is at least the smallest that ``most`` words reach; never more than ``most``."""
    counts = stage(count_words(docs, text, vocabulary).where(F.octet_length("word") <= WORD_BYTES), "words")
    # how many words have each count, from the top; counts above 4096 are one class by powers of two
    rank = F.expr("if(n < 4096, n, shiftleft(1L, cast(floor(log2(n)) as int)))")
    classes = counts.groupBy(rank.alias("c")).agg(F.count(F.lit(1)).alias("words")).collect()  # some 4,150 rows at most
    least, total = None, 0
    for r in sorted(classes, key=lambda r: -r["c"]):
        total += r["words"]
        if total > most:
            break
        least = r["c"]
    if least is None:
        return []
    return sorted((r["word"] for r in counts.where(F.col("n") >= least).select("word").collect()), key=str.encode)


# ---------------------------------------------------------------- encoding

class Encoder:
    """Encodes and decodes batches of texts; one per worker task."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon):
        self.vocab, self.lexicon = vocab, lexicon
        self.outputs = pa.ListArray.from_arrays(pa.array(lexicon.starts, pa.int32()), pa.array(lexicon.ids, pa.int32()))

    def words(self, words: list[str]) -> pa.ListArray:
        """Ids of distinct pre-tokens: from the lexicon, merged where it has none. A special token's string is its id."""
        raw, special = [w.encode() for w in words], self.vocab.special
        places = self.lexicon.places(raw)
        known, lacked = np.flatnonzero(places >= 0), np.flatnonzero(places < 0)
        made = self.vocab.merge_all([raw[k] for k in lacked.tolist()])
        for n, k in enumerate(lacked.tolist() if special else ()):
            if words[k] in special:
                made[n] = np.int32(special[words[k]]).tobytes()
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, made), np.int64, len(made)) // 4)])
        merged = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(made), np.int32)))
        order = np.empty(len(words), np.int64)
        order[np.concatenate([known, lacked])] = np.arange(len(words))
        return pa.concat_arrays([self.outputs.take(pa.array(places[known])), merged]).take(pa.array(order))

    def encode(self, texts: pa.Array) -> tuple[Cut, np.ndarray, np.ndarray]:
        """The texts' units, the ids of all distinct units in a row, and where each unit's begin and end."""
        cut, split, special = Cut(texts, self.vocab), self.vocab.split, self.vocab.special
        # Units that begin with a blank and a non-blank are cut into pre-tokens in one go: none reaches over their ends.
        whole = [k for k, u in enumerate(cut.units) if u[:1] == " " and u[1:2] and not u[1].isspace()]
        found = split("".join([cut.units[k] for k in whole]))
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        unit_ends = np.cumsum(np.fromiter((len(cut.units[k]) for k in whole), np.int64, len(whole)))
        number = np.zeros(len(cut.units), np.int64)
        number[whole] = np.diff(np.searchsorted(ends, unit_ends, side="right"), prepend=0)
        rest = np.setdiff1d(np.arange(len(cut.units)), whole, assume_unique=True).tolist()
        for k in rest:
            own = [cut.units[k]] if cut.units[k] in special else split(cut.units[k])
            number[k] = len(own)
            found += own
        coded = pa.array(found, pa.string()).dictionary_encode()
        ids = self.words(coded.dictionary.to_pylist()).take(coded.indices)
        # units in the order in which their pre-tokens were found, then back
        order = np.array(whole + rest, np.int64)
        bounds = ids.offsets.to_numpy()[np.concatenate([[0], np.cumsum(number[order])])]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        made = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), ids.values).take(pa.array(back))
        return cut, made.values.to_numpy(zero_copy_only=False), made.offsets.to_numpy().astype(np.int64)

    def ids(self, texts: pa.Array) -> pa.Array:
        """The ids of each text."""
        out = []
        for part in slices(texts):
            cut, flat, starts = self.encode(part)
            made = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.int32())).take(pa.array(cut.codes))
            ends = made.offsets.to_numpy()[cut.offsets]
            out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made.values))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

    def decode(self, ids) -> str:
        known = self.vocab.decoded
        return b"".join([known[i] for i in ids]).decode("utf-8", "replace")


_LOADED: dict = {}


def load_vocabulary(path: str) -> Vocabulary:
    """The vocabulary, read once per worker process."""
    if ("vocab", path) not in _LOADED:
        _LOADED["vocab", path] = Vocabulary(path)
    return _LOADED["vocab", path]


def load_encoder(path: str, digest: str, block) -> Encoder:
    """The worker's encoder for a lexicon, which tasks of the same lexicon share."""
    if _LOADED.get("digest") != (path, digest):
        _LOADED["encoder"] = Encoder(load_vocabulary(path), Lexicon(block()))
        _LOADED["digest"] = (path, digest)
    return _LOADED["encoder"]


def build_lexicon(docs: DataFrame, text: str, path: str, most: int = LEXICON) -> bytes:
    words = frequent_words(docs, text, lambda: load_vocabulary(path), most)
    vocab = load_vocabulary(path)
    raw = [w.encode() for w in words]
    return compile_lexicon(raw, [vocab.merge(w) for w in raw])


def _encoder_of(spark: SparkSession, docs: DataFrame, text: str, path: str):
    block = build_lexicon(docs, text, path)
    sent, digest = spark.sparkContext.broadcast(block), hashlib.sha256(block).hexdigest()  # bounded by LEXICON
    return lambda: load_encoder(path, digest, lambda: sent.value)


def with_ids(df: DataFrame, text: str, path: str, name: str = "ids") -> DataFrame:
    """``df`` with the ids of its text."""
    encoder = _encoder_of(df.sparkSession, df, text, path)
    return with_arrow_columns(df, text, [(fresh(df, name), T.ArrayType(T.IntegerType()))], lambda texts: [encoder().ids(texts)])


def _offsets(binary: pa.Array) -> np.ndarray:
    return np.frombuffer(binary.buffers()[1], np.int64)[binary.offset:binary.offset + len(binary) + 1]


def _joined(table: pa.Array, flat: np.ndarray, starts: np.ndarray, cut: Cut) -> tuple[memoryview, np.ndarray]:
    """What ``table`` has for the ids of all texts in a row, and where each text's begins and ends."""
    shown = table.take(pa.array(flat))
    data = shown.buffers()[2] or pa.py_buffer(b"")
    units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(_offsets(shown)[starts].tobytes()), data])
    made = units.take(pa.array(cut.codes))
    return memoryview(made.buffers()[2] or b""), _offsets(made)[cut.offsets]


def with_round_trip(df: DataFrame, text: str, path: str) -> DataFrame:
    """``df`` with n_tokens, ids_sha256 and decoded_sha256: digests of the ids and of their decoding."""
    encoder = _encoder_of(df.sparkSession, df, text, path)

    def run(texts):
        enc = encoder()
        counts, ids_sha, text_sha = [], [], []
        for part in slices(texts):
            cut, flat, starts = enc.encode(part)
            total = np.concatenate([[0], np.cumsum(np.diff(starts)[cut.codes])])[cut.offsets]
            counts += np.diff(total).tolist()
            shown, at = _joined(enc.vocab.decimal, flat, starts, cut)
            ids_sha += [hashlib.sha256(shown[a:max(a, b - 1)]).hexdigest() for a, b in zip(at, at[1:])]
            raw, at = _joined(enc.vocab.raw, flat, starts, cut)
            text_sha += [hashlib.sha256(bytes(raw[a:b]).decode("utf-8", "replace").encode()).hexdigest() for a, b in zip(at, at[1:])]
        return [counts, ids_sha, text_sha]

    return with_arrow_columns(df, text, [(fresh(df, "n_tokens"), T.LongType()), (fresh(df, "ids_sha256"), T.StringType()),
                                        (fresh(df, "decoded_sha256"), T.StringType())], run)


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@pipeline_stage
def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents with their token ids and the round trip's result."""
    path = vocabulary_path()
    ids, ok = fresh(docs, "ids"), fresh(docs, "round_trip")
    encoder = _encoder_of(spark, docs, "text", path)

    def run(texts):
        enc = encoder()
        made = enc.ids(texts)
        return [made, [enc.decode(i.values.to_numpy()) == t.as_py() for i, t in zip(made, texts)]]

    return with_arrow_columns(docs, "text", [(ids, T.ArrayType(T.IntegerType())), (ok, T.BooleanType())], run)
