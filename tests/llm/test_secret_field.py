"""The field of the secret scan: I in training and in spans, precision and recall on planted secrets."""

import random
import string
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from tallywise.llm import secrets_crf as S  # noqa: E402

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def windows(docs):
    return S.training_windows(docs, "doc_id", "text")


@pytest.fixture(scope="module")
def field(windows):
    return S.fit(S.training_sequences(windows))


def test_every_token_of_a_span_is_labelled():
    text = 'set secret="ab12cd=cd34=ef56" and go'
    spots = list(S.TOKEN.finditer(text))
    got = {m[0]: y for m, y in zip(spots, S.labels_of(text, spots, [(4, 28)]))}
    assert got["ab12cd"] == S.B and got["cd34"] == got["ef56"] == S.I and got["secret"] == got["set"] == got["go"] == S.O
    assert [y for m, y in zip(spots, S.labels_of(text, spots, [(4, 28)])) if m[0] == "="] == [S.O, S.I, S.I]


def test_windows_keep_their_file_feature_and_inside_is_learnt(docs, windows, field):
    texts = [r.text for r in docs.collect()]
    for w in windows[::97]:
        assert w["file"] in {S.file_feature(t) for t in texts if w["part"] in t}
    assert len({w["file"] for w in windows}) > 1
    labels = [y for _, ys in S.training_sequences(windows) for y in ys]
    assert labels.count(S.I) > 30 and labels.count(S.B) > 30
    assert field.unary[field.names["joint"], S.I] > field.unary[field.names["joint"], S.B]


def planted(seed):
    """(text, start, end) of secrets that no base pattern matches, in words of the table's kind; and clean lines."""
    rng, words = random.Random(seed), "the of and to in house river morning over under green letter table people".split()
    letters, lines, clean = string.ascii_letters + string.digits, [], []

    def some(n):
        return " ".join(rng.choice(words) for _ in range(n))

    def value(n):
        return "".join(rng.choices(letters, k=n - 2)) + rng.choice(string.digits) + rng.choice(string.digits)

    for k in range(160):
        v = value(rng.randrange(16, 40))
        if k % 4 == 0:
            v = value(8) + "=" + value(9) + "=" + value(8)
        lead = rng.choice(["Bearer ", "credential: ", "auth is ", "access key ", "the secret is ", "password \"", "api key: "])
        before, after = some(rng.randrange(2, 9)), some(rng.randrange(2, 9))
        text = f"{before} {lead}{v}{chr(34) if lead.endswith(chr(34)) else ''} {after}"
        lines.append((text, len(before) + 1 + len(lead), len(before) + 1 + len(lead) + len(v)))
        clean.append(rng.choice([f"{some(5)} {rng.randrange(10**6)} {some(4)}", f"{some(3)} on {rng.randrange(28) + 1}.{rng.randrange(12) + 1}.19{rng.randrange(90) + 10}, {some(4)}",
                                 f"call 555-{rng.randrange(9000) + 1000} {some(6)}", f"{some(4)} mail{rng.randrange(99)}@example.com {some(3)}",
                                 f"the password {some(6)}", f"{some(4)} token of {some(5)}"]))
    return lines, clean


def test_planted_secrets(field):
    feats, hit, whole, extra, inside = S.Features(), 0, 0, 0, 0
    lines, clean = planted(11)
    for text, a, b in lines:
        spans = [(x, y) for x, y, k in S.scan(text, field, feats) if k == 3]
        assert not S.base_spans(text)
        hit += any(x < b and a < y for x, y in spans)
        whole += (a, b) in spans
        extra += sum(not (x < b and a < y) for x, y in spans)
        inside += any((x, y) == (a, b) and "=" in text[a:b] for x, y in spans)
    wrong = sum(bool(S.scan(t, field, feats)) for t in clean)
    recall, precision = hit / len(lines), hit / max(1, hit + extra + wrong)
    print(f"planted: recall {recall:.3f}, whole {whole / len(lines):.3f}, precision {precision:.3f}, of several tokens {inside}")
    assert recall >= 0.9 and precision >= 0.95 and inside >= 20
