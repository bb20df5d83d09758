import random

import pytest
from texts import corpus, table

from curbside.llm import byte_pairs
from curbside.llm.alignment import BYTE_LEVEL
from curbside.llm.byte_pairs import encode, encoder_of, ranks_of
from curbside.llm.token_files import TOKENIZER, _encoder, count_tokens

SPACES = " \t\n\x0b\x0c\r\x85\xa0      　"


@pytest.fixture(scope="module")
def ours():
    return encoder_of(ranks_of(open(BYTE_LEVEL, "rb").read()))


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTE_LEVEL)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def odd(rng):
    parts = ["word", "'s", "'ll x", " 12", "<|endoftext|>", "é", "漢字", "\U0001f600", "...", "\x1c",
             "\x1f", "​", "a" * 30, "_", "Ā"]
    out = ""
    for _ in range(rng.randrange(1, 12)):
        out += rng.choice(parts) if rng.random() < 0.6 else rng.choice(SPACES) * rng.randrange(1, 9)
    return out


@pytest.mark.parametrize("long", [2, 3, 1 << 15])
def test_cutting_runs_leaves_the_ids_alone(monkeypatch, ours, reference, long):
    pattern = byte_pairs._LONG.pattern.replace(str(byte_pairs.LONG_RUN), str(long))
    monkeypatch.setattr(byte_pairs, "_LONG", byte_pairs.re.compile(pattern))
    rng = random.Random(long)
    texts = [odd(rng) for _ in range(400)] + [d[1] for d in corpus(n=20)]
    texts += [" ", "  ", "\n\n", "", " x", "  x", "x  ", " \n x \n "]
    for text in texts:
        assert encode(ours, text) == reference(text), repr(text)


def test_both_vocabulary_files_are_the_same(ours):
    other = _encoder(open(TOKENIZER, "rb").read())
    rng = random.Random(1)
    for _ in range(100):
        text = odd(rng)
        assert encode(ours, text) == encode(other, text)


def test_endless_runs(spark, ours):
    size = 5_000_000
    texts = [" " * size + "x", "\n" * size, "a" * size, "\t " * (size // 2) + "y", "1" * size]
    for text in texts:
        ids = encode(ours, text)
        assert ours.decode(ids) == text
    rows = count_tokens(table(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)]))
    assert {r.doc_id: r.n_tokens for r in rows.collect()} == {
        i: len(encode(ours, t)) for i, t in enumerate(texts)
    }
