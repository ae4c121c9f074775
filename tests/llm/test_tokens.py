import random

import public_tokenizers
import pytest
from conftest import EDGES
from tokenizers import Tokenizer

from tricycle.llm.tokens import CHUNK, CountingTransducer, TokenCounter, class_table, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as file:
        return TokenCounter(file.read(), class_table())


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_random_texts(counter, library):
    rng = random.Random(3)
    letters = [*"abc rvlestmd''  \n\t  é9½!?-_日🙂ſ", "<|endoftext|>", " ", " ", "​", "́"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(3000)]
    points = lambda: chr(rng.choice([rng.randrange(0x300), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)]))
    texts += ["".join(points() for _ in range(30)) for _ in range(1000)]
    assert counter.counts(texts).tolist() == library(texts)


@pytest.mark.parametrize("shift", range(0, CHUNK, 7))
def test_contractions_and_white_space_across_chunks(counter, library, shift):
    tails = ["don't", "I'll we're they've", "a  b", "a \n b", "\n's", " 's", "x's", "'l", "'r ", "   ", "''s", "'lx 'vE"]
    texts = ["x" * (CHUNK - 4 + shift % 8) + t for t in tails] + [" " * shift + t for t in tails]
    assert counter.counts(texts).tolist() == library(texts)


def test_long_pieces_and_a_small_cache(library):
    with open(PATH, encoding="utf-8") as file:
        counter = TokenCounter(file.read(), class_table())
    counter.counting.limit = 50
    texts = ["a" * 5000, "ab" * 3000, " " * 3000 + "x", "=-" * 2000, "antidisestablishmentarianism " * 40]
    assert counter.counts(texts).tolist() == library(texts)


def test_merges_in_order_of_rank():
    transducer = CountingTransducer([(b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"c", b"c")])
    for text in (b"", b"a", b"abc", b"bcc", b"abcc", b"cabcbc", b"ccc"):
        assert transducer.count(text) == len(transducer.encode(text))


def test_table(clashing, nothing, library):
    found = token_counts(clashing, PATH, limit=20).collect()
    texts = [r[1] or "" for r in EDGES]
    expected = sorted(zip([str(r[0]) for r in EDGES], [len(t.encode()) for t in texts], library(texts), strict=True))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == expected
    assert all(r.over_limit == (r.n_tokens > 20) for r in found)
    assert token_counts(nothing, PATH).collect() == []
