"""Secret scans: fixed patterns, and a linear-chain conditional random field.

The patterns (kinds assign, access, hex) are the base. The field tags tokens
B (secret begins), I (inside) or O from their shape, the words around them and
features of the whole text, and is decoded by Viterbi; runs of B and I that
touch no base span are added as kind ``crf``.

The field is trained here, by gradient ascent on the conditional likelihood,
on at most ``SAMPLE`` windows of each of three sorts (around base spans, around
digits or long tokens, plain text), taken by smallest hash over all documents.
Base spans are its weak labels: of a span's value the first token is B, all others are I. Each
positive window also appears with its secret and its wording replaced, by values of one and of several
tokens, and plain windows with a keyword or something harmless with digits put in, so that shape and wording are
learned apart from each other.
A window keeps the file feature of the text that it comes from.

The label space is part of the model: a token without digits, of under ``LONG``
characters, away from any keyword and no sign between two tokens that may be secrets can only be O. Such tokens cut a text into
short runs whose best paths are independent, so only the runs are decoded, and
the joined paths are the exact Viterbi path of the whole text.

Defined cases: null and empty texts have no spans; ties between paths go to O;
repeated rows get equal spans; very long texts are tagged whole, in memory and time
in proportion to their length; columns of the input keep their names, added ones get a leading underscore where they
clash (``scan_digest`` reads doc_id and text alone); a corpus without base spans trains no field and
adds none; empty input gives empty output.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.llm.common import fresh, pipeline_stage, with_text_columns

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the same as all runs of which the short are dropped
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "crf")
STEMS = ("passw", "secret", "token", "api")  # one of them is in every assign match, lower-cased

SAMPLE = 300          # windows of each sort that the field is fitted on, at most
GROUPS = 64           # of tasks, whose windows meet before all do
VARIANTS = 4          # rewordings of each positive window
REACH = 60            # characters to each side of a window's centre
ROUNDS = 80
RATE = 0.5
DECAY = 2e-5
LONG = 20             # characters from which a token without digits may be a secret
NEAR = 4              # tokens after a keyword whose context features mention it
JOINTS = frozenset("=:~%&$#!*|")  # signs that may stand inside a secret
COMMON = 5            # a neighbouring word is a feature from so many times in the sample

TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s]")
ACTIVE = re.compile(r"[0-9]|[\w+/.\-]{%d,}" % LONG)
DIGITS = frozenset("0123456789")
KEYWORD = re.compile(r"(?ai)pass(?:word|wd|phrase)?|secrets?|tokens?|api_?-?keys?|keys?|credentials?|auth|bearer|access")
O, B, I = range(3)
NEVER = -1e6


_NO_TOKEN = bytes(b if b >= 128 or chr(b).isalnum() or chr(b) in "_+/.-" else 32 for b in range(256))


class Signals:
    """What a text may hold at all, found at the speed of bytes: digits, runs that may be
    tokens of LONG characters (counted in bytes, so never too few), and its lower case."""

    def __init__(self, text: str):
        raw = text.encode()
        self.low = text.lower()
        self.digit = len(raw.translate(None, b"0123456789")) < len(raw)
        self.long = max(map(len, raw.translate(_NO_TOKEN).split()), default=0) >= LONG


def base_spans(text: str, signals: Signals | None = None) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base patterns, ordered."""
    found, signals = [], signals or Signals(text)
    if any(s in signals.low for s in STEMS):
        found += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST]
    if signals.long:  # both patterns below lie within one token of at least LONG characters
        found += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
        found += [(*m.span(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def join_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


# ---------------------------------------------------------------- features

def shape_features(token: str) -> tuple[str, ...]:
    """Features of a token by itself."""
    n = len(token)
    size = "1" if n == 1 else "2" if n < 4 else "4" if n < 8 else "8" if n < 16 else "16" if n < 20 else "20" if n < 32 else "32"
    if not token[0].isalnum() and n == 1:
        return ("punct:" + token,) if token in "\"'=:,.;()<>|" else ("punct:other",)
    digits = sum(c in DIGITS for c in token)
    sorts = "".join(s for s, f in (("l", str.islower), ("u", str.isupper), ("d", DIGITS.__contains__)) if any(map(f, token)))
    sorts += "s" if any(c in "+/_.-" for c in token) else ""
    sorts += "" if token.isascii() else "n"
    share = digits * 4 // n
    turns = sum((a in DIGITS) != (b in DIGITS) for a, b in zip(token, token[1:]))
    out = [f"sorts:{sorts}", f"size:{size}", f"sorts+size:{sorts}/{size}", f"digits:{share}",
           f"turns:{min(turns, 6)}", f"distinct:{min(len(set(token)) * 4 // n, 4)}/{size}"]
    if KEYWORD.fullmatch(token):
        out.append("keyword")
    return tuple(out)


def is_active(token: str) -> bool:
    return len(token) >= LONG or not DIGITS.isdisjoint(token)


def is_joint(tokens: list[str], k: int) -> bool:
    """A sign between two tokens that may be secrets."""
    return tokens[k] in JOINTS and 0 < k < len(tokens) - 1 and is_active(tokens[k - 1]) and is_active(tokens[k + 1])


def file_feature(text: str) -> str:
    """One feature of the whole text: how dense its digits are."""
    digits = sum(text.count(d) for d in "0123456789")
    return f"file:{0 if not digits else 1 if digits * 100 < len(text) else 2 if digits * 10 < len(text) else 3}"


class Features:
    """Feature names of each token in context, none for tokens that can only be O;
    shapes are remembered for common tokens."""

    def __init__(self):
        self.shapes: dict[str, tuple[str, ...]] = {}

    def shape(self, token: str) -> tuple[str, ...]:
        got = self.shapes.get(token)
        if got is None:
            if len(self.shapes) > 50_000:
                self.shapes.clear()
            got = self.shapes[token] = shape_features(token)
        return got

    def beside(self, side: str, token: str) -> list[str]:
        """Features of a neighbour: its shape, and the word itself."""
        out = [f"{side}:{token}" if token in "=:\"'@()<>,|" else f"{side}:{self.shape(token)[0]}"]
        if token.isalpha() and len(token) <= 14:
            out.append(f"{side}-word:{token.lower()}")
        return out

    def of(self, tokens: list[str], file: str) -> list[list[str]]:
        out, keyword = [], -99
        n = len(tokens)
        for k, token in enumerate(tokens):
            active, near = is_active(token), k - keyword <= NEAR
            joint = is_joint(tokens, k)
            own = [*self.shape(token)] if active or near or joint else ["keyword"] if KEYWORD.fullmatch(token) else []
            if near:
                own += ["after-keyword", f"after-keyword/{k - keyword}"]
                if tokens[k - 1] in "=:\"'":
                    own.append("after-keyword-sign")
            if joint:
                own.append("joint")
            if active:
                own.append(file)
            if active or joint:
                own += self.beside("before", tokens[k - 1]) if k else ["before:<"]
                own += self.beside("then", tokens[k + 1]) if k + 1 < n else ["then:>"]
            if "keyword" in own:
                keyword = k
            out.append(own if active or near or joint else [])
        return out


# ---------------------------------------------------------------- the field

def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Field:
    """Weights of label scores by feature, and of label transitions."""

    def __init__(self, names: dict[str, int], unary: np.ndarray, steps: np.ndarray):
        self.names, self.unary, self.steps = names, unary, steps

    def scores(self, feats: list[list[str]]) -> np.ndarray:
        get, unary = self.names.get, self.unary
        out = np.zeros((len(feats), 3))
        for k, own in enumerate(feats):
            if not own:
                out[k, B] = out[k, I] = NEVER
                continue
            ids = [i for f in own if (i := get(f)) is not None]
            if ids:
                out[k] = unary[ids].sum(axis=0)
        return out

    def decode(self, feats: list[list[str]]) -> list[int]:
        """Viterbi; I may only follow B or I."""
        x, s = self.scores(feats), self.steps.copy()
        s[O, I] = NEVER
        best = x[0].copy()
        best[I] = NEVER
        back = np.zeros((len(x), 3), np.int8)
        for k in range(1, len(x)):
            to = best[:, None] + s
            back[k] = to.argmax(axis=0)
            best = to.max(axis=0) + x[k]
        path = [int(best.argmax())]
        for k in range(len(x) - 1, 0, -1):
            path.append(int(back[k, path[-1]]))
        return path[::-1]


def fit(sequences: list[tuple[list[list[str]], list[int]]], rounds: int = ROUNDS) -> Field:
    """Maximise the conditional log-likelihood by Adagrad on the whole sample."""
    count = Counter(f for feats, _ in sequences for own in feats for f in own)
    names = {f: k for k, f in enumerate(sorted(f for f, c in count.items() if c >= COMMON or "-word:" not in f))}
    n, length = len(sequences), max(len(f) for f, _ in sequences)
    # tokens with equal features share a row, so a round costs no more than the sample has rows
    sets: dict[tuple[int, ...], int] = {}
    ids = np.zeros((n, length), int)
    gold = np.zeros((n, length), int)
    live = np.zeros((n, length), bool)
    for a, (feats, labels) in enumerate(sequences):
        for k, own in enumerate(feats):
            ids[a, k] = sets.setdefault((bool(own), *(names[f] for f in own if f in names)), len(sets))
        gold[a, :len(labels)] = labels
        live[a, :len(labels)] = True
    has = np.zeros((len(sets), len(names)))
    for own, k in sets.items():
        has[k, list(own[1:])] = 1.0
    only_o = np.zeros((len(sets), 3))
    only_o[[k for own, k in sets.items() if not own[0]], 1:] = NEVER
    unary, steps = np.zeros((len(names), 3)), np.zeros((3, 3))
    seen_u, seen_s = np.full_like(unary, 1e-8), np.full_like(steps, 1e-8)
    true = np.eye(3)[gold] * live[:, :, None]
    pair = live[:, 1:]
    true_steps = np.einsum("nka,nkb->ab", true[:, :-1], true[:, 1:] * pair[:, :, None])
    for _ in range(rounds):
        x = (has @ unary + only_o)[ids]
        up, down = np.zeros_like(x), np.zeros_like(x)
        up[:, 0] = x[:, 0]
        for k in range(1, length):
            to = _sum_exp(up[:, k - 1, :, None] + steps, 1) + x[:, k]
            up[:, k] = np.where(live[:, k, None], to, up[:, k - 1])
        for k in range(length - 2, -1, -1):
            to = _sum_exp(steps + (x[:, k + 1] + down[:, k + 1])[:, None, :], 2)
            down[:, k] = np.where(live[:, k + 1, None], to, 0.0)
        total = _sum_exp(up[:, -1], 1)
        p = np.exp(up + down - total[:, None, None]) * live[:, :, None]
        joint = np.exp(up[:, :-1, :, None] + steps + (x[:, 1:] + down[:, 1:])[:, :, None, :] - total[:, None, None, None])
        grad_s = true_steps - (joint * pair[:, :, None, None]).sum(axis=(0, 1)) - DECAY * n * steps
        diff = true - p
        by_set = np.stack([np.bincount(ids.ravel(), diff[:, :, y].ravel(), len(sets)) for y in range(3)], axis=1)
        grad_u = has.T @ by_set - DECAY * n * unary
        seen_u += grad_u ** 2
        seen_s += grad_s ** 2
        unary += RATE * grad_u / np.sqrt(seen_u)
        steps += RATE * grad_s / np.sqrt(seen_s)
    return Field(names, unary, steps)


# ---------------------------------------------------------------- training rows

def _cut(text: str, a: int, b: int) -> tuple[int, int]:
    """A window around a..b that ends between blanks where there are any near."""
    lo, hi = max(0, a - REACH), min(len(text), b + REACH)
    if lo:
        m = re.compile(r"\s").search(text, lo, a)
        lo = m.end() if m else lo
    if hi < len(text):
        m = re.compile(r"\s\S*$").search(text[b:hi])
        hi = b + m.start() if m else hi
    return lo, hi


def windows(text: str) -> list[tuple[str, str, list[int], str]]:
    """At most one window of each sort: (sort, window, base spans within it as start, end, ..., the text's file feature)."""
    signals = Signals(text)
    out, spans = [], base_spans(text, signals)
    if spans:
        lo, hi = _cut(text, spans[0][0], spans[0][1])
        out.append(("secret", text[lo:hi], [v - lo for a, b, _ in spans if lo <= a and b <= hi for v in (a, b)]))
    starts = [a for a, _, _ in spans]
    for m in ACTIVE.finditer(text) if signals.digit or signals.long else ():
        k = bisect_left(starts, m.end())
        if not any(b > m.start() - REACH for _, b, _ in spans[:k]) and not any(a < m.end() + REACH for a in starts[k:k + 1]):
            lo, hi = _cut(text, *m.span())
            out.append(("number", text[lo:hi], []))
            break
    if not out and text:
        mid = len(text) // 2
        lo, hi = _cut(text, mid, mid)
        out.append(("plain", text[lo:hi], []))
    file = file_feature(text)
    return [(*w, file) for w in out]


def training_windows(docs: DataFrame, doc_id: str, text: str, sample: int = SAMPLE) -> list:
    """The ``sample`` windows of each sort with the smallest hash, over all documents."""
    rows = docs.select(F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            made = [w for t in batch.column(0).to_pylist() if t for w in windows(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w[0] for w in made], pa.string()), pa.array([w[1] for w in made], pa.string()),
                 pa.array([w[2] for w in made], pa.list_(pa.int32())), pa.array([w[3] for w in made], pa.string())],
                ["sort", "part", "spans", "file"])

    made = rows.mapInArrow(run, "sort string, part string, spans array<int>, file string").withColumn("group", F.spark_partition_id() % GROUPS)

    def first(frame: DataFrame, *keys: str) -> DataFrame:
        order = W.partitionBy(*keys).orderBy(F.xxhash64("part"), "part", "file")
        return frame.withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample)

    # each task keeps its first rows of a sort before anything moves; tasks meet by groups,
    # so the last step has GROUPS x sample rows of a sort at most, however many tasks there are
    return first(first(made, "sort", "group"), "sort").orderBy("sort", "k").collect()


_SIGNS = (" = \"{}\"", ": {}", "={}", ": \"{}\"", " is {}", " {}")
_WORDS = ("token", "password", "secret", "api_key", "apikey", "access key", "Bearer", "credential", "auth")
_ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
              "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/")


def labels_of(text: str, spots: list, spans: list[tuple[int, int]]) -> list[int]:
    """A label for each token. Of a span the keyword and signs before the value stay O; the value's first
    token is B, every further one I, up to one that can only be O."""
    tokens = [m[0] for m in spots]
    live = {k for lo, hi in live_runs(tokens) for k in range(lo, hi)}
    labels = [O] * len(spots)
    for a, b in spans:
        began = False
        for k in range(bisect_left(spots, a, key=lambda m: m.start()), len(spots)):
            if spots[k].end() > b or began and k not in live:
                break
            if began:
                labels[k] = I
            elif is_active(tokens[k]) and len(tokens[k]) > 5:
                labels[k], began = B, True
    return labels


def _labelled(text: str, spans: list[tuple[int, int]], feats: Features, file: str):
    """Features and labels of each run."""
    spots = list(TOKEN.finditer(text))
    tokens = [m[0] for m in spots]
    labels, own = labels_of(text, spots, spans), feats.of(tokens, file)
    for lo, hi in live_runs(tokens):
        a, b = max(0, lo - 1), min(len(tokens), hi + 1)
        yield own[a:b], labels[a:b]


def _value(rng: random.Random) -> str:
    """A made-up secret, of one token or of several with a sign between them."""
    parts = 1 if rng.random() < 0.6 else rng.randrange(2, 4)
    alphabet, sign = rng.choice(_ALPHABETS), rng.choice("=:~%$")
    while True:
        made = ["".join(rng.choices(alphabet, k=rng.randrange(14, 44) if parts == 1 else rng.randrange(6, 16))) for _ in range(parts)]
        if parts == 1 or all(is_active(p) and TOKEN.fullmatch(p) for p in made):
            return sign.join(made)


def _harmless(rng: random.Random) -> str:
    """Something with digits that is no secret: an address, a name with a number, a version."""
    word = lambda: "".join(rng.choices("abcdefghilmnoprstu", k=rng.randrange(3, 9)))
    n = rng.randrange(10 ** rng.randrange(1, 5))
    return rng.choice((f"{word()}{n}@{word()}.{word()[:3]}", f"{word()}.{n}@{word()}{n % 10}.{word()[:3]}", f"{word()}{n}", f"{word()}-{n}", f"v{n % 10}.{n % 7}"))


def training_sequences(rows: list, seed: int = 7) -> list:
    rng, feats, out = random.Random(seed), Features(), []
    for r in rows:
        part, spans, file = r["part"], list(zip(r["spans"][::2], r["spans"][1::2])), r["file"]
        if not TOKEN.search(part):
            continue
        out.extend(_labelled(part, spans, feats, file))
        if spans:
            a, b = spans[0]
            for _ in range(VARIANTS):
                value = _value(rng)
                wording = rng.choice(_WORDS) + rng.choice(_SIGNS)
                at = a + len(wording.split("{}")[0])
                text = part[:a] + wording.format(value) + part[b:]
                out.extend(_labelled(text, [(at, at + len(value))], feats, file))
        elif r["sort"] == "plain":
            cut = part.find(" ", len(part) // 2)
            if cut > 0:
                out.extend(_labelled(part[:cut] + " " + rng.choice(_WORDS) + rng.choice(("", ":", " =")) + part[cut:], [], feats, file))
                out.extend(_labelled(part[:cut] + " " + _harmless(rng) + part[cut:], [], feats, file))
    return [s for s in out if s[0]]


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Field | None:
    """A field fitted on the bounded sample; None where no document has a base span."""
    rows = training_windows(docs, doc_id, text)
    if not any(r["sort"] == "secret" for r in rows):
        return None
    return fit(training_sequences(rows))


# ---------------------------------------------------------------- scanning

def _quiet(signals: Signals) -> bool:
    """True only if no token has a digit, LONG characters or a keyword before it."""
    if signals.digit or signals.long:
        return False
    return not any(w in signals.low for w in ("pass", "secret", "token", "key", "credential", "auth", "bearer", "access"))


def field_spans(field: Field, text: str, feats: Features, signals: Signals) -> list[tuple[int, int]]:
    """Runs of B and I on the best path."""
    if _quiet(signals):
        return []
    spots = list(TOKEN.finditer(text))
    if not spots:
        return []
    path = decode_runs(field, [m[0] for m in spots], feats, file_feature(text))
    out = []
    for m, y in zip(spots, path):
        if y == B or y == I and not out:
            out.append(list(m.span()))
        elif y == I:
            out[-1][1] = m.end()
    return [tuple(s) for s in out]


def live_runs(tokens: list[str]) -> list[tuple[int, int]]:
    """Runs of tokens that may be other than O, as first and past-last positions."""
    runs, keyword = [], -99
    for k, t in enumerate(tokens):
        if is_active(t) or k - keyword <= NEAR or is_joint(tokens, k):
            if runs and runs[-1][1] == k:
                runs[-1][1] = k + 1
            else:
                runs.append([k, k + 1])
        if t[0].isalpha() and KEYWORD.fullmatch(t):
            keyword = k
    return runs


def decode_runs(field: Field, tokens: list[str], feats: Features, file: str) -> list[int]:
    """The Viterbi path: each run with what its features look at and an O on each side."""
    path = [O] * len(tokens)
    for lo, hi in live_runs(tokens):
        a, b = max(0, lo - NEAR - 1), min(len(tokens), hi + 1)
        path[lo:hi] = field.decode(feats.of(tokens[a:b], file))[lo - a:hi - a]
    return path


def scan(text: str, field: Field | None, feats: Features) -> list[tuple[int, int, int]]:
    """All spans of a text: the base, and the field's that touch none of them."""
    signals = Signals(text)
    spans = base_spans(text, signals)
    if field is None or not text:
        return spans
    extra = []
    for a, b in field_spans(field, text, feats, signals):
        if not any(a < y and x < b for x, y, _ in spans):
            extra.append((a, b, 3))
    return sorted(spans + extra, key=lambda s: (s[0], s[2], s[1])) if extra else spans


def with_spans(df: DataFrame, field: Field | None, text: str, name: str) -> DataFrame:
    """``df`` with a column of spans as start, end, kind, start, ..."""
    sent = df.sparkSession.sparkContext.broadcast(field)  # bounded by the sample's features

    def run(texts):
        feats = Features()
        return [[[v for s in scan(t, sent.value, feats) for v in s] for t in texts]]

    return with_text_columns(df, text, [(name, T.ArrayType(T.IntegerType()))], run)


def redact(text: str | None, flat: list[int]) -> str | None:
    """The text with every span replaced by a mark; overlapping spans count as one."""
    if not flat or text is None:
        return text
    spans = sorted(zip(flat[::3], flat[1::3]))
    merged = [list(spans[0])]
    for a, b in spans[1:]:
        if a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, at = [], 0
    for a, b in merged:
        out += [text[at:a], "[SECRET]"]
        at = b
    return "".join(out) + text[at:]


@pipeline_stage
def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, every secret in their texts replaced; n_chars follows the text."""
    sent = spark.sparkContext.broadcast(train(docs))
    name = fresh(docs, "redacted")

    def run(texts):
        feats = Features()
        return [[redact(t, [v for s in scan(t, sent.value, feats) for v in s]) for t in texts]]

    made = with_text_columns(docs, "text", [(name, T.StringType())], run)
    made = made.withColumn("text", F.when(F.col("text").isNotNull(), F.col(name))).drop(name)
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        made = made.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return made.select(*docs.columns)


def scan_digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, of each document."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs))  # bounded by the sample's features

    def run(texts):
        feats, out = Features(), [[] for _ in range(5)]
        for t in texts:
            spans = scan(t, sent.value, feats)
            base = [s for s in spans if s[2] != 3]
            for k in range(3):
                out[k].append(sum(s[2] == k for s in base))
            out[3].append(hashlib.sha256(join_spans(base).encode()).hexdigest())
            out[4].append(join_spans(spans))
        return out

    fields = [("n_assign", T.LongType()), ("n_access", T.LongType()), ("n_hex", T.LongType()),
              ("base_sha256", T.StringType()), ("spans", T.StringType())]
    return with_text_columns(docs.select("doc_id", "text"), "text", fields, run).drop("text")
