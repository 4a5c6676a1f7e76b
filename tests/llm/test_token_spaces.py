"""Token ids of texts whose white space is not single blanks and line feeds, against the library."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirework.llm import token_store


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return Tokenizer.from_file(path), token_store.CachedTokenizer(open(path, "rb").read(), special_as_text=False)


def test_white_space(both):
    library, own = both
    rng = np.random.default_rng(3)
    texts = ["one\u00a0two\u00a0three\n\n\nfour", "a\tb\tc\n\n", "one two three\n\n\nfour", "a \t b\tc", "x\r\ny\r\n\n z", " a", "a ", "\n", "", "a b\nc"]
    texts += ["".join(rng.choice(["ab", "c1", ".", " ", " ", "\n", "\n", "\t", "\r", " ", "\u0085", " ", "\x1c", "é"], 14)) for _ in range(3000)]
    kind = own.kind
    assert [np.frombuffer(x, kind).tolist() for x in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


BLANKS = [chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x200B, 0xFEFF]]
SPECIAL = "<|endoftext|>"


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([*BLANKS, " ", " ", "\n", SPECIAL, SPECIAL[:5], "don't", "'S", "x1", "é", "中", "\0"]), st.text(max_size=3)), max_size=14).map("".join))
def test_any_text(both, text):
    library, own = both
    assert np.frombuffer(own.encode([text])[0], own.kind).tolist() == library.encode(text, add_special_tokens=False).ids


def test_many_random_texts(both):
    library, own = both
    rng = np.random.default_rng(8)
    parts = ["ab", "c1", ".", " ", " ", "\n", "word", "Tab", SPECIAL, "it's", *BLANKS]
    for special in (False, True):
        library.encode_special_tokens = special
        mine = token_store.CachedTokenizer(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read(), special)
        texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(50_000)]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, mine.kind).tolist() for x in mine.encode(texts)] == want
    library.encode_special_tokens = False


def test_marker(both):
    library, own = both
    assert np.frombuffer(own.encode(["a <|endoftext|> b"])[0], own.kind).tolist() == library.encode("a <|endoftext|> b", add_special_tokens=False).ids and 50256 in library.encode("a <|endoftext|> b").ids


def test_damaged_shard():
    data = bytearray(token_store.pack_shard([1, 2], [b"ab", b"cdef"], 2))
    assert token_store.Shard(bytes(data)).ids(1).tobytes() == b"cdef"
    data[-1] ^= 1
    with pytest.raises(ValueError):
        token_store.Shard(bytes(data))
