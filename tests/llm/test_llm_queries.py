"""The ten operators' queries against brute force on whole small tables, and edge cases."""

import hashlib
import math
import re
import struct
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import __spark_entry__ as entry  # noqa: E402
from tallywise.llm import (bpe_lexicon, chat_format, license_templates, mixing_tree, nn_descent, quality_mcd,  # noqa: E402
                           secrets_crf, shard_tree, simhash_tiles, token_planes)

SF = "/root/testdata/sf0.001"
BLANKS = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT_kept string, kept string, row string"
EDGE = [(1, None, "en", "a", None, None, "x", "y"), (2, "", None, None, 0, None, None, None), (None, "null id here", "en", "a", 12, "", "", ""),
        (4, "same text " * 30, "en", None, 300, "", "", ""), (4, "same text " * 30, "en", None, 300, "", "", ""),
        (6, "x" * 50_000, "de", "b", 50_000, "", "", ""), (7, "word " * 40_000, "de", "b", 200_000, "", "", ""),
        (8, "\n\n \t", "fr", "c", 4, "", "", ""), (9, "é" * 300 + " <|endoftext|> \u00a0 \x1c end", "fr", "c", 320, "", "", "")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOC_SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def run(spark, name, sf=SF):
    return [r.asDict() for r in entry.queries()[name](spark, sf).collect()]


# ------------------------------------------------------------- 1 secrets

def base_by_hand(text):
    found = []
    for m in re.finditer(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets(spark, rows):
    got = {r["doc_id"]: r for r in run(spark, "op1_secret_scan")}
    assert len(got) == len(rows)
    for r in rows:
        want, g = base_by_hand(r["text"] or ""), got[r["doc_id"]]
        assert g["base_sha256"] == sha(",".join(f"{secrets_crf.KINDS[k]}:{a}:{b}" for a, k, b in want))
        assert (g["n_assign"], g["n_access"], g["n_hex"]) == tuple(sum(x[1] == k for x in want) for k in range(3))
        spans = g["spans"].split(",") if g["spans"] else []
        assert [s for s in spans if not s.startswith("crf")] == [f"{secrets_crf.KINDS[k]}:{a}:{b}" for a, k, b in want]


def viterbi_by_hand(field, feats):
    """Every path of up to nine tokens."""
    from itertools import product
    x, best = field.scores(feats), None
    for path in product(range(3), repeat=len(feats)):
        if path[0] == 2 or any(a == 0 and b == 2 for a, b in zip(path, path[1:])):
            continue
        score = sum(x[k, y] for k, y in enumerate(path)) + sum(field.steps[a, b] for a, b in zip(path, path[1:]))
        if best is None or score > best[0] + 1e-9:
            best = (score, path)
    return best


def test_crf_finds_what_patterns_miss(spark):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field, feats = secrets_crf.train(big), secrets_crf.Features()
    hidden = ['the token "Zk39dJf83KfLs02MxPq7vT" was sent', 'secret is 9F86D081884C7D659A2FEAA0C55AD015 now',
              'her api_key 4fjK20sLq9xZ71mNb3 here', 'use Bearer a8Kd93jfLs02kdP1msQz77 please']
    hit = [any(k == 3 for _, _, k in secrets_crf.scan(t, field, feats)) for t in hidden]
    assert sum(hit) >= 3, hit
    clean = ["call (499) 555-6503 or mail that.92@mail2.example.com", "the secret garden and the token ring were lost",
             "pages 12-48 of volume 1999", "4785380592391139 is a number", "password reset: please wait"]
    assert [secrets_crf.scan(t, field, feats) for t in clean] == [[]] * len(clean)
    new = total = 0
    for r in big.collect():
        spans = secrets_crf.scan(r.text or "", field, feats)
        new += sum(s[2] == 3 for s in spans)
        total += 1
    assert new <= total * 0.01  # clean texts stay clean
    for text in [*hidden, *clean]:  # the runs' paths are the whole text's best path
        spots = [m[0] for m in secrets_crf.TOKEN.finditer(text)][:9]
        own = feats.of(spots, secrets_crf.file_feature(text))
        x = field.decode(own)
        score = sum(field.scores(own)[k, y] for k, y in enumerate(x)) + sum(field.steps[a, b] for a, b in zip(x, x[1:]))
        assert math.isclose(score, viterbi_by_hand(field, own)[0], abs_tol=1e-6)
        assert x == secrets_crf.decode_runs(field, spots, feats, secrets_crf.file_feature(text))


def test_redaction():
    assert secrets_crf.redact("a token=abcdefg b", [2, 15, 0]) == "a [SECRET] b"
    assert secrets_crf.redact("0123456789", [1, 4, 0, 3, 6, 2, 8, 9, 1]) == "0[SECRET]67[SECRET]9"
    assert secrets_crf.redact(None, []) is None


def test_secrets_edge(spark, edge, empty):
    assert secrets_crf.scan_digest(edge).count() == len(EDGE)
    assert secrets_crf.scan_digest(empty).count() == 0
    out = secrets_crf.secrets_stage(spark, edge, SF)
    assert out.columns == edge.columns and out.count() == len(EDGE)
    assert {r["text"] for r in out.collect()} == {r[1] for r in EDGE}


# ------------------------------------------------------------- 2 BPE

def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(public_tokenizers.path(name))
    made.no_truncation()
    made.no_padding()
    return made


def test_bpe(spark, rows):
    got, lib = {r["doc_id"]: r for r in run(spark, "op2_bpe")}, library("byte_bpe_50k.json")
    for r in rows:
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids) and g["ids_sha256"] == sha(",".join(map(str, ids)))
        assert g["decoded_sha256"] == sha(lib.decode(ids, skip_special_tokens=False))


ODD = ["", " ", "  ", "a  b", " a", "a ", "\n a\n\n b \n", "a \t b", "don't  we'll ''s 's", "x\u00a0y \u00a0z", "a\x1cb \x1c c", "\u0085 \u2003 q",
       "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>", " <|endoftext|> ", "１２ ²³ Ⅷ ½", "日本語 テキスト", "é e\u0301 \u0301x",
       "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 40, "!?!? #$%& ..", "\U0001f600\U0001f601 ok", "a\r\nb\r\n  c"]


def encoder():
    path = bpe_lexicon.vocabulary_path()
    vocab = bpe_lexicon.load_vocabulary(path)
    words = sorted({w for t in ODD[:14] for w in vocab.split(t)}, key=str.encode)
    raw = [w.encode() for w in words if len(w.encode()) <= bpe_lexicon.WORD_BYTES]
    return bpe_lexicon.Encoder(vocab, bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon(raw, [vocab.merge(w) for w in raw])))


def test_bpe_odd_texts():
    lib, enc = library("byte_bpe_50k.json"), encoder()
    for text, ids in zip(ODD, enc.ids(pa.array(ODD)).to_pylist()):
        assert ids == lib.encode(text, add_special_tokens=False).ids, repr(text)
        assert enc.decode(ids) == lib.decode(ids, skip_special_tokens=False) == text


def test_bpe_character_classes():
    """Every assigned character of the basic plane is cut as by the library."""
    lib, enc = library("byte_bpe_50k.json"), encoder()
    import unicodedata
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    texts = ["".join(f"a{c}1 {c}b" for c in chars[k:k + 200]) for k in range(0, len(chars), 200)]
    for text, ids in zip(texts, enc.ids(pa.array(texts)).to_pylist()):
        assert ids == lib.encode(text, add_special_tokens=False).ids


def test_lexicon_is_exact_and_minimal():
    words = sorted({f"{a}{b}{c}".encode() for a in ("", "re", "un", "x") for b in ("do", "tie", "é") for c in ("", "s", "ing", "ed")})
    ids = [[k, k + 1][: 1 + k % 2] for k in range(len(words))]
    lex = bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon(words, ids))
    asked = words + [b"", b"dos\0", b"red", b"zzz", b"x" * 100]
    assert lex.places(asked).tolist() == [*range(len(words)), *[-1] * 5]
    assert [lex.output(k) for k in range(len(words))] == ids
    suffixes = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in [w[:k] for k in range(len(w) + 1)]}
    assert len(lex.finals) == len(suffixes)  # one state for each different set of endings: minimal
    assert bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon([], [])).places([b"a", b""]).tolist() == [-1, -1]


def test_bpe_edge(spark, edge, empty):
    lib = library("byte_bpe_50k.json")
    got = bpe_lexicon.with_round_trip(edge.select("doc_id", "text"), "text", bpe_lexicon.vocabulary_path()).collect()
    assert sorted(r["ids_sha256"] for r in got) == sorted(
        sha(",".join(map(str, lib.encode(r[1] or "", add_special_tokens=False).ids))) for r in EDGE)
    assert bpe_lexicon.with_round_trip(empty.select("doc_id", "text"), "text", bpe_lexicon.vocabulary_path()).count() == 0
    out = bpe_lexicon.bpe_stage(spark, edge, SF)
    assert out.columns == [*edge.columns, "ids", "round_trip"] and all(r["round_trip"] for r in out.collect())


# ------------------------------------------------------------- 3 SimHash

def fingerprint_by_hand(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(BLANKS, text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def components_by_hand(fps):
    """Least id reachable, by comparing all pairs; fps: list of (id, fingerprint)."""
    distinct = sorted({f for _, f in fps})
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if bin(a ^ b).count("1") <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, f in fps:
        r = find(f)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return [least[find(f)] for _, f in fps]


def test_simhash(spark, rows):
    got = {r["doc_id"]: r for r in run(spark, "op3_simhash")}
    fps = [(r["doc_id"], fingerprint_by_hand(r["text"] or "")) for r in rows]
    for (d, f), c in zip(fps, components_by_hand(fps)):
        assert (got[d]["fingerprint"], got[d]["component_id"]) == (f"{f:016x}", c)


def test_simhash_components_of_planted_fingerprints(spark):
    """Chains, stars and a dense ball of links, near the tile limits too."""
    rng = np.random.default_rng(5)
    fps = [0, 1, 7, 2 ** 64 - 1, 2 ** 63, 2 ** 64 - 8]
    chain = int(rng.integers(2 ** 62))
    for _ in range(30):
        chain ^= 1 << int(rng.integers(64))
        chain ^= 1 << int(rng.integers(64))
        fps.append(chain)
    centre = int(rng.integers(2 ** 62))
    fps += [centre ^ (1 << i) ^ (1 << j) for i in range(0, 40) for j in range(i)]
    fps += [int(x) for x in rng.integers(0, 2 ** 63, 3000)]
    fps = sorted(set(fps))
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = {r["node"]: r["root"] for r in simhash_tiles.components(simhash_tiles.links(frame)).collect()}
    want = components_by_hand([(k, f) for k, f in enumerate(fps)])
    mine, theirs = defaultdict(set), defaultdict(set)
    for k, s in enumerate(signed):
        mine[found.get(s, s)].add(k)
        theirs[want[k]].add(k)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))
    assert simhash_tiles.links(frame).count() < 4 * len(fps)  # spanning links, not all pairs


def test_simhash_edge(spark, edge, empty):
    out = simhash_tiles.near_duplicates(edge)
    got = [(r["doc_id"], r["component_id"]) for r in out.collect()]
    fps = [(r[0], fingerprint_by_hand(r[1] or "")) for r in EDGE]
    assert sorted(got, key=str) == sorted(zip([f[0] for f in fps], components_by_hand(fps)), key=str)
    assert simhash_tiles.near_duplicates(empty).count() == 0
    kept = simhash_tiles.dedup_stage(spark, edge, SF)
    assert kept.columns == edge.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(["1", "None", "4", "6", "7", "9"])


# ------------------------------------------------------------- 4 chat

def test_chat_edge(spark):
    data = [(1, 0, "user", None), (1, 1, "assistant", "### x </turn> \\ \\### ####"), (1, None, "assistant", "last"), (None, 0, None, ""),
            (2, 0, "assistant", ""), (2, 0, "assistant", ""), (3, 5, "we\\ird </turn>", "a" * 70_000), (3, 6, "assistant", "b" * 70_000)]
    data += [(9, k, "assistant" if k % 2 else "user", f"turn {k} ### said " * 20) for k in range(3000)]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.formatted(frame).collect()}
    groups = defaultdict(list)
    for r in data:
        groups[r[0]].append(r)
    assert set(got) == set(groups)
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[1] is None, r[1] or 0))
        said = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)
        loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        g = got[conv]
        assert (g["n_turns"], g["turns_sha256"], g["loss_chars"], g["loss_sha256"]) == (len(turns), sha(said), len(loss), sha(loss))
        assert g["formatted_chars"] == sum(13 + len(chat_format.escape(r or "")) + len(chat_format.escape(t or "")) for _, _, r, t in turns)
    assert chat_format.formatted(frame.limit(0)).count() == 0


def test_escape_is_reversible():
    for t in ["", "\\", "\\\\", "###", "\\###", "####", "</turn>", "\\</turn>", "<//turn> </turn", "\\\\###\\", "# ## ### #### #####", "\\### Assistant: </turn> ok"]:
        e = chat_format.escape(t)
        assert chat_format.unescape(e) == t
        assert not re.search(r"(?<!\\)</turn>", e.replace("\\\\", ""))


# ------------------------------------------------------------- 5 planes

def test_planes(spark, rows):
    got, lib, start = {r["doc_id"]: r for r in run(spark, "op5_token_planes")}, library("word_bpe_49k.json"), 0
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        ids = [*lib.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        g = got[r["doc_id"]]
        assert (g["start"], g["n_tokens"]) == (start, len(ids))
        assert g["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_planes_odd_texts():
    lib = library("word_bpe_49k.json")
    odd = [*ODD, "e \u0301\u0301 A\u030a ΑΣ Σ İI", "\u1100\u1161 \u1161", "<|startoftext|>a <|ENDOFTEXT|>"]
    for text, raw in zip(odd, token_planes.encode(odd, token_planes.vocabulary_path())):
        assert np.frombuffer(raw, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text)


def test_plane_file_round_trip():
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, 2 ** 32, n, np.uint32) for n in (1, 70_000, 3, 200_000)]
    base, docs, lengths, flat = token_planes.unpack_file(token_planes.pack_file(17, [5, None, -3, 9], [i.tobytes() for i in ids]))
    assert (base, docs, lengths.tolist()) == (17, [5, None, -3, 9], [len(i) for i in ids])
    assert np.array_equal(flat, np.concatenate(ids))


def test_planes_edge(spark, edge, empty):
    lib = library("word_bpe_49k.json")
    got = token_planes.planes_round_trip(edge).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter(
        (r[0], 1 + len(lib.encode(r[1] or "", add_special_tokens=False).ids)) for r in EDGE)
    order = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order][:2] == [None, 1]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(order, order[1:]))
    assert token_planes.planes_round_trip(empty).count() == 0


# ------------------------------------------------------------- 6 quality

def stats_by_hand(text):
    words = re.findall(BLANKS, text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(BLANKS, line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, hit = Counter(wins), set()
    for i, w in enumerate(wins):
        if often[w] > 1:
            hit.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def mcd_by_hand(x):
    """The same estimator in numpy, all rows of a group at hand."""
    mean = np.array([np.sort(c)[(len(c) - 1) // 2] for c in x.T])
    inv = np.linalg.inv(np.diag(np.square(quality_mcd.FLOOR)))
    for _ in range(quality_mcd.STEPS):
        d2 = np.einsum("ni,ij,nj->n", x - mean, inv, x - mean)
        bins = np.floor(quality_mcd.BINS_PER_OCTAVE * np.log2(np.maximum(d2, 1e-9)))
        before = np.array([(bins < b).sum() for b in bins])
        y = x[before < quality_mcd.H * len(x)]
        cov = np.atleast_2d(np.cov(y.T, bias=True)) * quality_mcd.CONSISTENCY * len(y) / (len(y) + quality_mcd.PRIOR_ROWS)
        mean, inv = y.mean(axis=0), np.linalg.inv(cov + np.diag(np.square(quality_mcd.FLOOR)))
    return np.einsum("ni,ij,nj->n", x - mean, inv, x - mean)


def test_quality(spark, rows):
    got, groups = {r["doc_id"]: r for r in run(spark, "op6_quality")}, defaultdict(list)
    for r in rows:
        n, chars, sym, dup, rep = stats_by_hand(r["text"] or "")
        g = got[r["doc_id"]]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == (n, chars, sym, dup, rep)
        assert g["base_failed"] == (n < 20 or 100 * rep > 30 * n)
        x = [math.log1p(n), math.log((chars + 1) / (n + 1)), math.log1p(100 * sym / (chars + 1)), math.log1p(dup), math.log1p(100 * rep / (n + 1))]
        groups[r["lang"], r["source"]].append((r["doc_id"], x))
    for members in groups.values():
        for (d, _), dist in zip(members, mcd_by_hand(np.array([x for _, x in members]))):
            assert math.isclose(got[d]["mahalanobis"], dist, rel_tol=1e-6, abs_tol=1e-6)
            assert got[d]["kept"] == (not got[d]["base_failed"] and dist <= quality_mcd.CUTOFF)


def test_quality_follows_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in run(spark, "op6_quality", sf)}
    marks = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if not got[r["doc_id"]]["base_failed"]]
    good, bad = ([got[r["doc_id"]]["kept"] for r in marks if r["quality"] == q] for q in (1, 0))
    assert sum(good) >= 0.995 * len(good)
    assert sum(bad) <= 0.25 * len(bad)


@pytest.mark.parametrize("share", [0.34, 0.45])
def test_quality_rejects_a_large_bad_part(spark, share):
    """One source with a third or more of junk: copies of a bad document, and labelled bad documents."""
    from pyspark.sql import functions as F
    sf = "/root/testdata/sf0.01"
    judged = quality_mcd.with_stats(spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id"))
    clean = judged.where(~quality_mcd.base_failed(F.col("n_words"), F.col("n_repeat_words"))).orderBy("doc_id").collect()
    good, bad = ([r["text"] for r in clean if r["quality"] == q] for q in (1, 0))
    n = int(share * len(good) / (1 - share))
    for junk in ([bad[0]] * n, [bad[k % len(bad)] for k in range(n)]):
        frame = spark.createDataFrame([(t, "en", "one", ok) for ok, part in ((True, good), (False, junk)) for t in part],
                                      "text string, lang string, source string, good boolean")
        got = quality_mcd.judge(frame).groupBy("good").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
        kept = {r["good"]: r["kept"] for r in got}
        assert kept[True] >= 0.995 and kept[False] <= 0.15, kept


def test_quality_edge(spark, edge, empty):
    got = quality_mcd.judge(edge, kept="verdict").collect()
    assert Counter((r["doc_id"], r["base_failed"]) for r in got) == Counter({(1, True): 1, (2, True): 1, (None, True): 1, (4, True): 2, (6, True): 1, (7, True): 1, (8, True): 1, (9, True): 1})
    assert quality_mcd.judge(empty, kept="verdict").count() == 0
    assert quality_mcd.quality_stage(spark, edge, SF).columns == edge.columns


# ------------------------------------------------------------- 7 sharding

def spark_hash(*values):
    h = 42
    for v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return h


def place_by_hand(tree, doc):
    def pick(weights, *path):
        return min((-math.log((((spark_hash(shard_tree.SEED, doc, *path, k)) >> 11) + 0.5) * 2.0 ** -53) / w, k) for k, w in enumerate(weights) if w > 0)[1]
    r = pick([sum(map(sum, racks)) for racks in tree], 0)
    k = pick([sum(s) for s in tree[r]], 1, r)
    s = pick(tree[r][k], 2, r, k)
    return sum(len(x) for q in tree[:r] for x in q) + sum(len(x) for x in tree[r][:k]) + s


def test_sharding(spark, rows):
    got = run(spark, "op7_sharding")
    by, text = {r["doc_id"]: r for r in got}, {r["doc_id"]: r["text"] or "" for r in rows}
    tree = shard_tree.even_tree(40)
    for d, t in text.items():
        g = by[d]
        assert (g["size"], g["text_crc32"], g["law"]) == (len(t.encode()) + 16, zlib.crc32(t.encode()), "key")
        assert g["shard"] == place_by_hand(tree, d)
        assert g["grown_shard"] == place_by_hand(shard_tree.with_new_region(tree), d)
        assert g["grown_shard"] in (g["shard"], 40)
    slots = defaultdict(list)
    for g in got:
        slots[g["shard"]].append(g["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_moves_stay_in_changed_subtrees(spark):
    from pyspark.sql import functions as F
    tree = shard_tree.even_tree(40)
    heavy = [[list(s) for s in racks] for racks in tree]
    heavy[1][2][3] = 3.0  # region 1, rack 2
    ids = spark.range(20_000).select(shard_tree.place(tree, F.col("id")).alias("a"), shard_tree.place(heavy, F.col("id")).alias("b"))
    got = ids.collect()
    load = Counter(r["a"] for r in got)
    assert set(load) == set(range(40)) and max(load.values()) < 650 and min(load.values()) > 370
    region, rack = lambda s: s // 20, lambda s: s // 5
    for r in got:
        if r["a"] != r["b"]:
            assert region(r["b"]) == 1                      # only the heavier region gains
            if region(r["a"]) == 1:
                assert rack(r["b"]) == 6                    # within it, only the heavier rack
                if rack(r["a"]) == 6:
                    assert r["b"] == 33                     # and within that, only the heavier shard


def test_sharding_spreads_equal_rows(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(shard_tree, "PIECE", 10, raising=False)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        frame = spark.createDataFrame([(None, None)] * 1005 + [(7, f"text {k}") for k in range(50)] + [(8, "x")], "doc_id long, text string")
        got = shard_tree.shard_documents(frame).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(key, before)
    slots, tasks = defaultdict(list), Counter(r["task"] for r in got if r["doc_id"] is None)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert len(got) == 1056 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(tasks) > 3 and max(tasks.values()) < 700, tasks


def test_sharding_edge(spark, edge, empty):
    got = shard_tree.shard_documents(edge).collect()
    assert len(got) == len(EDGE) and Counter(r["doc_id"] for r in got) == Counter(r[0] for r in EDGE)
    assert all(r["grown_shard"] in (r["shard"], 40) for r in got)
    assert shard_tree.shard_documents(empty).count() == 0


# ------------------------------------------------------------- 8 licenses

def test_licenses(spark, rows):
    got = {r["doc_id"]: r for r in run(spark, "op8_licenses")}
    for r in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        hits = [(k, label) for phrase, label in license_templates.PHRASES for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
        g = got[r["doc_id"]]
        assert (g["n_words"], g["n_base"]) == (len(words), len(hits))
        assert (g["first_word"], g["last_word"]) == (min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None))
        assert g["base_labels"] == ",".join(sorted({x for _, x in hits}))
        assert set(g["base_labels"].split(",")) <= set(g["labels"].split(",")) and 0 <= g["score"] <= 1


def regex_of(wording):
    """A template as a pattern over blank-joined words."""
    out, parts = "", license_templates.MARKUP.split(wording)
    for k in range(0, len(parts), 3):
        out += "".join(f"(?: {re.escape(w.decode())})" for w in license_templates.words_of(parts[k]))
        if k + 1 < len(parts):
            out += {"beginOptional": "(?:", "endOptional": ")?"}.get(parts[k + 1], f"(?: [^ ]+){{0,{parts[k + 2]}}}")
    return re.compile(out + "(?= |$)")


def test_templates_match_like_patterns():
    import random
    rng = random.Random(3)
    for name, wording in license_templates.TEMPLATES.items():
        pattern = regex_of(wording)
        plain = [w.decode() for w in license_templates.words_of(license_templates.MARKUP.sub(" ", wording))]
        hits = 0
        for _ in range(300):
            words = list(plain)
            for _ in range(rng.randrange(4)):  # leave out, repeat or replace words
                k = rng.randrange(len(words))
                words[k:k + 1] = rng.choice([[], [words[k], words[k]], ["other"], words[k:k + 1]])
            parts = license_templates.MARKUP.split(wording)
            if rng.random() < 0.5:
                words = [w.decode() for k in range(0, len(parts), 3) for w in license_templates.words_of(parts[k])
                         if not (k and parts[k - 2] == "beginOptional" and rng.random() < 0.5)]
            text = "Before, " + " ".join(words) + ". After"
            want = bool(pattern.search(" " + " ".join(w.decode() for w in license_templates.words_of(text))))
            assert (name in license_templates.scan(text)[5].split(",")) == want, (name, text)
            hits += want
        assert hits > 20, name


MIT = """Copyright (c) 2020 A Holder

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_3 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_2 = "\n\n".join(p for p in BSD_3.split("\n\n") if not p.startswith("3."))
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
FSF = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
CC = "This work is licensed under a Creative Commons Attribution 4.0 International License."


def test_licenses_published_and_altered():
    def found(text):
        return set(license_templates.scan(text)[5].split(",")) - {"", "mit", "apache", "gpl"}

    for text, label, least in ((MIT, "mit-text", 0.95), (BSD_2, "bsd-2-clause-text", 1), (BSD_3, "bsd-3-clause-text", 1), (ISC, "isc-text", 1),
                               (FSF, "gpl-3.0-fsf-notice", 0.9), (APACHE, "apache-2.0-notice", 1), (CC, "cc-by-notice", 0.75)):
        assert found(text) == {label} and license_templates.scan(text)[6] >= least, label
    assert found(FSF.replace("version 3", "version 2").replace("software:", "software;")) == {"gpl-2.0-fsf-notice"}
    assert found(CC.replace("4.0 International", "3.0 United States")) == {"cc-by-notice"}
    assert found(CC.replace("Attribution", "Attribution-ShareAlike")) == set()
    mit_0 = MIT.replace(", subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "")
    assert mit_0 != MIT and found(mit_0) == set()
    assert found(MIT.replace("shall be included", "need not be included")) == set()
    assert found(BSD_3.replace("without specific prior", "with no")) == set()
    assert found(BSD_2.replace("must retain", "may omit")) == set()
    assert found(ISC.replace("appear in all copies", "appear in source copies")) == set()


def test_licenses_edge(edge, empty):
    assert license_templates.scan("Released under the MIT License. MIT license")[1:6] == (2, 3, 5, "mit", "mit,mit-notice")
    assert license_templates.with_licenses(edge.select("doc_id", "text")).count() == len(EDGE)
    assert license_templates.with_licenses(empty.select("doc_id", "text")).count() == 0


# ------------------------------------------------------------- 9 mixing

def test_mixing(spark, rows):
    sf = "/root/testdata/sf0.01"
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = run(spark, "op9_mixing", sf)
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    sizes, sources = Counter(), sorted({r["source"] for r in rows}, key=lambda s: s.encode())
    for r in rows:
        sizes[r["source"]] += len(re.findall(BLANKS, r["text"] or ""))
    wants = dict(zip(sources, mixing_tree.targets([sizes[s] for s in sources])))
    assert math.isclose(sum(wants.values()), 1.5 * sum(sizes.values()), rel_tol=1e-9)
    taken = Counter()
    for r in rows:
        g = by[r["doc_id"]]
        assert g["size"] == len(re.findall(BLANKS, r["text"] or "")) and g["source_size"] == sizes[r["source"]]
        assert math.isclose(g["target"], wants[r["source"]], rel_tol=1e-9) and 0 <= g["taken"] <= 2 * g["size"]
        taken[r["source"]] += g["taken"]
    for s in sources:
        assert abs(taken[s] - wants[s]) <= 0.01 * wants[s], (s, taken[s], wants[s])
    assert {(r["doc_id"], r["taken"]) for r in run(spark, "op9_mixing", sf)} == {(r["doc_id"], r["taken"]) for r in got}


def test_targets_and_tree():
    assert mixing_tree.targets([]) == [] and mixing_tree.targets([0, 0]) == [0, 0]
    assert mixing_tree.targets([100, 100, 100]) == [200, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    table = mixing_tree.split_quotas([500, 3, 0, 77, 1000], 64)
    assert table.sum(axis=0).tolist() == [500, 3, 0, 77, 1000]
    load = table.sum(axis=1)
    assert load.max() - load.min() <= 1
    means = np.mean([mixing_tree.split_quotas([60, 30, 10], 4, seed=s) for s in range(400)], axis=0)
    assert np.allclose(means, [[15, 7.5, 2.5]] * 4, atol=0.5)  # each shard has every source's share


def test_mixing_edge(spark, edge, empty):
    got = mixing_tree.mix_sizes(edge).collect()
    assert len(got) == len(EDGE) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert mixing_tree.mix_sizes(empty).count() == 0
    out = mixing_tree.mixing_stage(spark, edge, SF)
    assert out.columns == edge.columns and max(Counter(r["doc_id"] for r in out.collect() if r["doc_id"] != 4).values()) <= 2
    assert mixing_tree.mixing_stage(spark, empty, SF).count() == 0


# ------------------------------------------------------------- 10 neighbours

def test_nearest_recall(spark):
    sf = "/root/testdata/sf0.1"
    got = defaultdict(dict)
    for r in run(spark, "op10_nn_descent", sf):
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    norm = np.sqrt((x * x).sum(axis=1))
    hit = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        scores = (x @ x[q]) / (norm * norm[q])
        order = [k for k in np.lexsort((ids, -scores)) if k != q][:5]
        mine = got[int(ids[q])]
        assert sorted(mine) == [1, 2, 3, 4, 5]
        place = {int(i): k for k, i in enumerate(ids)}
        for v, s in mine.values():
            assert math.isclose(s, scores[place[v]], rel_tol=1e-12, abs_tol=1e-12)
        assert [mine[k] for k in range(1, 6)] == sorted(mine.values(), key=lambda p: (-p[1], p[0]))
        hit += len({v for v, _ in mine.values()} & set(ids[order].tolist()))
        total += 5
    assert hit >= 0.95 * total, hit / total


def test_nearest_follows_measured_recall(spark, monkeypatch):
    """Rounds go on until the graph settles, and a beam that finds too little is doubled."""
    shares, beams, descend, search = [], [], nn_descent.descend, nn_descent.search

    def counted(graph):
        made = descend(graph)
        shares.append(made.selectExpr("sum(changed) / sum(size(nbrs))").first()[0])
        return made

    def sized(*args):
        beams.append(args[4])
        return search(*args)

    monkeypatch.setattr(nn_descent, "descend", counted)
    monkeypatch.setattr(nn_descent, "search", sized)
    monkeypatch.setattr(nn_descent, "BEAM", 8)
    x = np.random.default_rng(4).standard_normal((6000, 64))
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = nn_descent.nearest(frame, every=100).collect()
    assert shares[-1] < nn_descent.CHANGED <= min(shares[:-1]) and len(shares) > 3
    assert beams[0] == 8 and max(beams) > 8
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = {q: set(np.argsort(-(unit @ unit[q]))[1:6].tolist()) for q in range(0, 6000, 100)}
    hit = sum(r["vec_id"] in near[r["query_id"]] for r in got)
    assert hit >= 0.95 * 300, hit / 300


def test_nearest_edge(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (100, [1.0, None]),
            (150, [1.0, 2.0, 3.0]), (200, [0.0, 0.0]), (6, [1.0, 0.0])] + [(k, [0.5, 0.25]) for k in range(300, 320)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = nn_descent.nearest(frame).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got if r["query_id"] == 0] == [(0, 1, 6), (0, 2, 50), (0, 3, 300), (0, 4, 301), (0, 5, 302)]
    assert [r["vec_id"] for r in got if r["query_id"] == 300] == [301, 302, 303, 304, 305]
    assert {r["query_id"] for r in got} == {0, 50, 300}
    few = nn_descent.nearest(frame.where("vec_id in (0, 1, 50)")).collect()
    assert Counter(r["query_id"] for r in few) == {0: 2, 50: 2}
    assert nn_descent.nearest(frame.limit(0)).count() == 0


def test_nearest_repeated_ids(spark):
    """Rows with one id and other vectors are queries of their own and candidates of each other; further columns are not read."""
    data = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0]), (50, [1.0, 0.0])]
    frame = spark.createDataFrame([(*d, "x", 1) for d in data], "vec_id long, embedding array<double>, query string, node int")
    got = defaultdict(list)
    for r in nn_descent.nearest(frame).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], round(r["score"], 9)))
    far, near = round(0.1 / math.sqrt(1.01), 9), round(1 / math.sqrt(1.01), 9)
    assert sorted(got[0]) == sorted([(1, 50, 1.0), (2, 1, near), (3, 2, far), (4, 0, 0.0),
                                     (1, 2, near), (2, 1, far), (3, 0, 0.0), (4, 50, 0.0)])
    assert sorted(got[50]) == [(1, 0, 1.0), (2, 1, near), (3, 2, far), (4, 0, 0.0)]


def test_graph_compares_only_pairs_with_a_new_member():
    vec = np.eye(3, dtype=np.float32)[[0, 0, 0]] + np.array([[0, 0, 0], [0, .1, 0], [0, 0, .1]], np.float32)

    def sent(new):
        ids, counts, cands, _ = nn_descent._send(np.array([7, 8, 9]), vec, np.full(3, -9.0, np.float32), np.array(new), 16)
        return {int(i): set(c.tolist()) for i, c in zip(ids, np.split(cands, np.cumsum(counts)[:-1]))}

    assert sent([True, True, True]) == {7: {8, 9}, 8: {7, 9}, 9: {7, 8}}
    assert sent([False, False, True]) == {7: {9}, 8: {9}, 9: {7, 8}}
    assert sent([False, False, False]) == {}


def shuffled_rows(df):
    """Rows that the exchanges of ``df`` wrote when it ran."""
    def walk(node):
        for inner in ("plan", "executedPlan"):
            if "QueryStage" in node.nodeName() and inner == "plan" or node.nodeName().startswith("AdaptiveSparkPlan") and inner == "executedPlan":
                return walk(getattr(node, inner)())
        own = node.metrics().get("shuffleRecordsWritten")
        below = node.children()
        return (own.get().value() if own.isDefined() else 0) + sum(walk(below.apply(k)) for k in range(below.size()))

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def near_graph(spark, n):
    x = np.random.default_rng(9).standard_normal((n, 16))
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "id long, vec array<double>")
    return nn_descent.build_graph(rows)


def test_graph_edges_are_no_rows(spark, monkeypatch):
    """A round and a step of the search shuffle fewer rows than there are nodes, whatever the number of edges and scored pairs."""
    graph, moved, stage = near_graph(spark, 3000), [], nn_descent.stage

    def counted(df, name):
        if name in ("graph", "pools"):
            moved.append(shuffled_rows(df))
        return stage(df, name)

    monkeypatch.setattr(nn_descent, "stage", counted)
    nn_descent.descend(graph)
    assert moved and sum(moved) < 3000, moved


def test_nearest_hubs(spark, monkeypatch):
    """Pools and links of nodes with many neighbours are dealt to several tasks, and the results stay right."""
    monkeypatch.setattr(nn_descent, "HUB", 64)
    rng = np.random.default_rng(6)
    x = np.vstack([np.ones((1, 16)), np.ones((1500, 16)) + rng.standard_normal((1500, 16)), rng.standard_normal((1500, 16))])
    hubs, links_of = [], nn_descent.links_of

    def held(graph, parts):
        links, own = links_of(graph, parts)
        hubs.append(own)
        keys = {r["key"] for r in links.select("key").collect()}
        assert all((h << nn_descent.SALT_BITS) + s in keys for h, n in own.items() for s in range(n))
        return links, own

    monkeypatch.setattr(nn_descent, "links_of", held)
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = nn_descent.nearest(frame).collect()
    assert hubs[0] and max(hubs[0].values()) > 2
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = {q: set(np.argsort(-(unit @ unit[q]))[1:6].tolist()) for q in range(0, 3001, 50)}
    assert sum(r["vec_id"] in near[r["query_id"]] for r in got) >= 0.95 * 5 * len(near)


def test_candidates_of_hubs():
    """The nearest of each row, a candidate once, as the neighbour that it is already; ties to the smaller id."""
    row, cand = np.array([1, 0, 0, 0, 1, 0]), np.array([5, 9, 3, 9, 4, 8])
    sims, late = np.array([.5, .7, .7, .7, .6, -1.01], np.float32), np.array([True, True, True, False, True, True])
    assert nn_descent._nearest(row, cand, sims, late).tolist() == [2, 3, 5, 4, 0]
    many = np.random.default_rng(1).permutation(100)
    got = nn_descent._nearest(np.zeros(100, int), many, -many.astype(np.float32) / 100, np.ones(100, bool))
    assert many[got].tolist() == list(range(nn_descent.NEIGHBOURS))


# ------------------------------------------------------------- pipeline

def test_pipeline(spark, rows):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mixing", "bpe"]
    kept = {r["doc_id"] for r in run(spark, "op6_quality") if r["kept"]}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    step = docs
    counts = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        step = stage(spark, step, SF).cache()
        assert step.columns == docs.columns
        counts.append({r["doc_id"]: r["text"] for r in step.collect()})
    assert set(counts[0]) == kept
    left = [(r["doc_id"], fingerprint_by_hand(r["text"] or "")) for r in rows if r["doc_id"] in kept]
    assert set(counts[1]) == set(components_by_hand(left))
    assert set(counts[2]) == set(counts[1])
    assert not any(base_by_hand(t or "") for t in counts[2].values())
    assert set(counts[3]) <= set(counts[2])
    final = corpus_pipeline.run(spark, SF).collect()
    assert all(r["round_trip"] for r in final)
    assert Counter(r["doc_id"] for r in final) == Counter(r["doc_id"] for r in step.collect())
    assert max(Counter(r["doc_id"] for r in final).values()) == 2
