"""Encoders on odd texts, long white space in chats, and who owns a stage's files."""

import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from tallywise.llm import bpe_lexicon, chat_format, common, quality_mcd, simhash_tiles, token_planes  # noqa: E402

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "x", "  two  blanks\n\n end ", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "don't 'S it's", "É é é İ! İ ²! ½, क़! ΑΣ, ﬁ!",
       "<|STARTOFTEXT|> <|startoftext|>! x<| |>y", "\x1c\x1d a b　 c", "tab\t\ttab \t x", "1234 5,6 a_b_! ABC---", "中文。字", "�\U0001f600!"]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    made = list(ODD)
    for _ in range(300):
        made.append("".join(draw.choice(["ab", "the ", " ", "É", "ß,", "'t", "\n", "0", "!!", "́", "<|", "endoftext", "|>", "Z", "  "]) for _ in range(draw.randrange(30))))
    return made


def test_words_merged_together_equal_words_merged_alone():
    vocab = bpe_lexicon.load_vocabulary(bpe_lexicon.vocabulary_path())
    draw = random.Random(1)
    words = [b"a" * n for n in range(1, 60)] + [b"ab" * 20, b"aaaab" * 5, b"\xff\xfe", b" " * 40, bytes(range(40))]
    words += [bytes(draw.choice(b"abceinorst .-\xc3\xa9") for _ in range(draw.randrange(1, 50))) for _ in range(3000)]
    assert vocab.merge_all(words) == [np.array(vocab.merge(w), np.int32).tobytes() for w in words]
    assert vocab.merge_all([]) == []


def test_byte_level_ids_equal_the_library(texts):
    path = bpe_lexicon.vocabulary_path()
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    vocab = bpe_lexicon.load_vocabulary(path)
    for words in ([], [b"the", b" the", b"ab"]):
        block = bpe_lexicon.compile_lexicon(sorted(words), [vocab.merge(w) for w in sorted(words)])
        made = bpe_lexicon.Encoder(vocab, bpe_lexicon.Lexicon(block)).ids(pa.array(texts))
        assert made.to_pylist() == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_word_ids_equal_the_library(texts, monkeypatch):
    path = token_planes.vocabulary_path()
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for held in (1 << 20, 500):  # with a memo that is emptied all the time, too
        monkeypatch.setattr(token_planes, "MEMO_BYTES", held)
        made = token_planes.PieceEncoder(path)
        got = [np.frombuffer(b, "<u4").tolist() for a, z in token_planes.slices(texts) for b in made.encode(texts[a:z])]
        assert got == want


def test_memory_of_texts_without_blanks_is_bounded(monkeypatch):
    """100 texts of 100 kB in one piece each: counters and memos go by bytes."""
    monkeypatch.setattr(token_planes, "MEMO_BYTES", 1 << 20)
    made = token_planes.PieceEncoder(token_planes.vocabulary_path())
    for k in range(100):
        made.encode([chr(97 + k % 26) * 100_000 + str(k)])
        assert sum(len(p) + len(b) for g in (made.memo, made.past) for p, b in g.items()) < 4 << 20


@pytest.mark.parametrize("run", [" " * 3_000_000, "\n" * 3_000_000, "\t" * 3_000_000, "a" + " \n" * 1_500_000 + "b", "word\n" + " " * 3_000_000 + "word"])
def test_long_white_space_in_chats(run):
    enc = chat_format.tokenizer(chat_format.rank_path())
    ids, loss = chat_format.assemble(enc, "assistant", run)
    turns, trained, _ = chat_format.read_chunk(enc, np.array(ids), chat_format.loss_mask(len(ids), loss[:1], loss[1:]))
    assert turns == [("assistant", run)] and trained == [run]


@pytest.mark.parametrize("text", ["a" + " " * 20_000 + "b", "\n" * 40_000, "x " + "\t" * 17_000 + " y  z", " " * 16_383 + "q", "　" * 30_000 + ".", "e\n" + "\r\n" * 20_000])
def test_long_white_space_has_the_ids_of_the_whole_text(text):
    enc = chat_format.tokenizer(chat_format.rank_path())
    assert chat_format.encode_text(enc, text) == enc.encode_ordinary(text)


def test_long_white_space_goes_through_a_job(spark):
    rows = [(1, 0, "user", " " * 3_000_000), (1, 1, "assistant", "so\n" + "\n" * 1_500_000)]
    got = chat_format.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert (got.n_turns, got.loss_chars) == (2, 1_500_003)


def test_two_stages_built_before_either_is_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    near = simhash_tiles.dedup_stage(spark, docs, SF)
    kept = quality_mcd.quality_stage(spark, docs, SF)
    again = simhash_tiles.dedup_stage(spark, docs, SF)
    assert near.count() == again.count() > 0 and kept.count() > 0
    paths = [p for held, paths in common._HELD for p in paths if held() is near]
    del near
    quality_mcd.quality_stage(spark, docs, SF)
    jvm = spark._jvm
    where = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    assert paths and not any(w.getFileSystem(spark._jsc.hadoopConfiguration()).exists(w) for w in where)  # nobody holds it any more
    assert kept.count() > 0 and again.count() > 0


def test_texts_come_in_runs_of_bytes():
    texts = pa.array(["a" * 10, None, "b" * 50, "", "c" * 5, "d" * 5])
    runs = list(common.byte_runs(texts, 20))
    assert runs == [(0, 2), (2, 2), (4, 2)] or sum(n for _, n in runs) == len(texts)
    assert list(common.byte_runs(pa.array([], pa.string()))) == []
