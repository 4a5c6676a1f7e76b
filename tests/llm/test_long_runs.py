"""Byte-level BPE of very long runs of one kind of character."""

import public_tokenizers
from test_id_operators import docs, tiktoken_model

from quirework.llm import bpe


def test_long_runs(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    n, model = 1_000_000, tiktoken_model()
    runs = [" ", "\t", "\n", "a", "中", "1", "-", "\x1c", "　"]
    texts = [c * n for c in runs] + [f"some words {' ' * n}end of it\n", "x" + " \n" * n + "\ty", " " * 70_000 + "b\x1cc  d"]
    got = {r.doc_id: r for r in bpe.round_trip(docs(spark, texts), path, pattern, with_ids=True).collect()}
    for i, text in enumerate(texts[: len(runs)]):
        # A run is one match.
        assert got[i].ids == model._encode_single_piece(text), i
    k = len(runs)
    assert got[k].ids == [*model.encode_ordinary("some words"), *model._encode_single_piece(" " * n), *model.encode_ordinary(" end of it\n")]
    assert got[k + 1].ids == [*model.encode_ordinary("x"), *model._encode_single_piece(" \n" * n), *model.encode_ordinary("\ty")]
    assert got[k + 2].ids == model.encode_ordinary(texts[k + 2])
