"""SimHash, embeddings, tokenizers, url rules, components and the pipeline: edge cases and plain models."""

import hashlib
import itertools
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.llm import bpe, elias_fano, embedding_dedup, hamming_trie, simhash, token_store, url_filter
from quirework.llm.components import connected_components

CLASH = ["fp", "_fp", "row", "id", "text_", "_text", "ids", "component_id", "part", "cls", "v"]


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").withColumns({c: F.lit(i) for i, c in enumerate(CLASH)})


def closure(nodes, links):
    """Smallest node reachable, by union and find."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()]
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_by_model(spark):
    rng = np.random.default_rng(2)
    long = " ".join(rng.choice(["Alpha", "beta", "Gamma", "délta", "eps"], 4000))
    texts = [long, long + " tail", long.replace("Alpha", "alpha"), None, "", " \n", "one", "one two", "ONE", "x" * 100_000, *(" ".join(rng.choice(list("abcdefgh"), 12)) for _ in range(60))]
    fps = [plain_fingerprint(t) for t in texts]
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if bin(fps[i] ^ fps[j]).count("1") <= 2]
    want = closure(range(len(texts)), links)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    assert {i: np.int64(r.fp).astype(np.uint64) for i, r in got.items()} == dict(enumerate(np.array(fps, np.uint64)))
    assert {i: r.component_id for i, r in got.items()} == want
    kept = simhash.one_of_each(docs(spark, texts))
    assert kept.columns == docs(spark, texts).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_simhash_null_and_repeated_ids(spark):
    d = docs(spark, ["a b c d", "a b c d", "a b c d", "other words here now", None], [5, 5, None, None, None])
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(d).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (None, None), (None, None)], key=str)
    kept = simhash.one_of_each(d).collect()
    assert len(kept) == 3 and sum(r.doc_id == 5 for r in kept) == 1
    assert simhash.one_of_each(d.limit(0)).count() == 0


def test_hamming_pairs_in_split_buckets(spark):
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    codes = np.unique(np.concatenate([centre ^ (np.uint64(1) << np.uint64(b)) ^ (np.uint64(1) << np.uint64(63 - b)) for b in range(0, 24, 3)] + [centre]))
    want = {tuple(sorted((int(a), int(b)))) for a, b in itertools.combinations(codes.view(np.int64), 2) if bin(int(a) ^ int(b) & (1 << 64) - 1).count("1") <= 2 or bin((int(a) ^ int(b)) & (1 << 64) - 1).count("1") <= 2}
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    for limit in (1 << 18, 16):
        assert {tuple(sorted((r.a, r.b))) for r in simhash.hamming_pairs(df, 2, max_bucket=limit).collect()} == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 255), min_size=2, max_size=60, unique=True), st.integers(0, 3))
def test_trie_walk_by_model(values, budget):
    codes = np.array(sorted(v * 0x0101010101010101 & (1 << 64) - 1 ^ v for v in values), np.uint64)
    codes = np.unique(codes)
    got = sorted((int(i), int(j)) for a, b in hamming_trie.self_join(codes, np.array([0]), np.array([len(codes)]), budget) for i, j in zip(a, b))
    want = [(i, j) for i, j in itertools.combinations(range(len(codes)), 2) if bin(int(codes[i]) ^ int(codes[j])).count("1") <= budget]
    assert got == want


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


def test_embeddings_by_model(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((60, 32))
    v = np.concatenate([centres, centres[:30] + 0.15 * rng.standard_normal((30, 32)), centres[:5] * 3, np.repeat(centres[:1], 40, 0)])
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(500, None), (501, [0.0] * 32), (502, [None] + [1.0] * 31), (503, [float("nan")] + [1.0] * 31), (504, [float("inf")] + [1.0] * 31), (505, []), (506, [1e-200] * 32), (507, [1e200] * 32), (None, [float(x) for x in v[0]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in CLASH})
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    cosine = unit @ unit.T
    links = [(i, j) for i, j in itertools.combinations(range(len(v)), 2) if cosine[i, j] >= 0.9]
    own = closure(range(len(v)), links)
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(df, block_rows=16, radius=128).collect()}
    assert len(got) == len(rows)
    near = {i: sum(i in p for p in links) for i in range(len(v))}
    like0 = {i for i in range(len(v)) if cosine[0, i] >= 0.9}
    assert all(got[i].component_id == own[i] and got[i].n_links == near[i] + (i in like0) for i in range(len(v)))
    assert got[None].n_links == len(like0) and got[None].component_id == 0 and not got[None].kept
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(500, 506))
    assert got[506].component_id == 506 and got[507].component_id == 506 and got[507].n_links == 1
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def planted_vectors(rng, dim, clusters, noise, common=0.0):
    """Groups of vectors around centres, with a strong direction common to all."""
    base = rng.standard_normal((clusters, dim)) + common * rng.standard_normal(dim)
    groups = [base[k] + noise[k % len(noise)] * np.linalg.norm(base[k]) / np.sqrt(dim) * rng.standard_normal((2 + k % 5, dim)) for k in range(clusters)]
    return np.concatenate(groups)


@pytest.mark.parametrize("dim,common", [(32, 0.0), (64, 1.5), (256, 0.0)])
def test_recall_through_the_tables(spark, dim, common):
    """Links found by the whole operator, near the threshold above all, against brute force."""
    x = planted_vectors(np.random.default_rng(dim), dim, 900, [0.25, 0.3, 0.33, 0.35, 0.4], common)
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    want, got = linked.sum(axis=1), np.zeros(len(x), int)
    for r in embedding_dedup.near_vectors(df).collect():
        got[r.vec_id] = r.n_links
    assert want.sum() > 1000 and (got <= want).all() and got.sum() >= 0.95 * want.sum(), (got.sum(), want.sum())


def test_dense_groups_count_alike(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.standard_normal((1, 48)) + 0.22 * rng.standard_normal((150, 48)), rng.standard_normal((40, 48)), rng.standard_normal((1, 48)) + 0.3 * rng.standard_normal((60, 48))])
    x = np.concatenate([x, x[:3]])
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = [(i, j) for i, j in itertools.combinations(range(len(x)), 2) if unit[i] @ unit[j] >= 0.9]
    own, near = closure(range(len(x)), links), np.bincount(np.array(links).ravel(), minlength=len(x))
    for options in ({}, {"block_rows": 20}, {"dense": 10**9}, {"dense": 0, "block_rows": 50}):
        got = {r.vec_id: r for r in embedding_dedup.near_vectors(df, radius=128, **options).collect()}
        assert len(got) == len(x)
        found = np.array([got[i].n_links for i in range(len(x))])
        assert (found <= near).all() and found.sum() >= 0.97 * near.sum(), (options, found.sum(), near.sum())
        assert {i: got[i].component_id for i in got} == own, options


def test_codes_are_balanced():
    x = np.random.default_rng(1).standard_normal((800, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotation = embedding_dedup.learn_rotation(x)
    bits = np.unpackbits(np.ascontiguousarray(rotation.codes(x)).view(np.uint8), axis=1, bitorder="little")
    assert bits.shape == (800, embedding_dedup.BITS) and (np.abs(bits.mean(axis=0) - 0.5) < 0.05).all()


TEXTS = [None, "", " ", "Hello world's  best\n\n\n  thing\t!", "don't 'S it’s", "é" * 3000, "word " * 40_000, "a" * 5000, "中文字符 and 😀", "x\0y <|endoftext|>", "　 z", "12 34a5"]


def tiktoken_model():
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    model, d = tiktoken_model(), docs(spark, [*TEXTS, TEXTS[3]], [*range(len(TEXTS)), None])
    rows = bpe.round_trip(d, path, pattern, with_ids=True).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        text = TEXTS[3 if r.doc_id is None else r.doc_id] or ""
        want = model.encode_ordinary(text)
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(bpe.encode(d, path, pattern), path, pattern).collect()}
    assert all(back[i] == (t or "").encode() for i, t in enumerate(TEXTS))
    assert bpe.round_trip(d.limit(0), path, pattern).count() == 0


def test_pieces_make_the_text():
    text = "one two\nthree_ four " * 20_000
    assert "".join(bpe.pieces(text, 1000)) == text and max(map(len, bpe.pieces(text, 1000))) < 1100
    assert list(bpe.pieces("a" * 5000, 1000)) == ["a" * 5000]


def test_token_store(spark, tmp_path):
    from tokenizers import Tokenizer

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(vocabulary)
    t.encode_special_tokens = True
    ids = [7, 3, 3, None, *range(20, 20 + len(TEXTS) - 4)]
    d = docs(spark, TEXTS, ids)
    path = str(tmp_path / "tokens")
    token_store.write_tokens(d, path, vocabulary, shard_bytes=4000)
    rows = token_store.read_tokens(spark, path).orderBy("start").collect()
    assert len(rows) == len(TEXTS) and [r.doc_id for r in rows] == sorted(ids, key=lambda i: (i is not None, i))
    by_id = {}
    for i, text in zip(ids, TEXTS):
        want = t.encode(text or "", add_special_tokens=False).ids + [0]
        by_id.setdefault(i, set()).add((len(want), zlib.crc32(np.array(want, "<u4").tobytes())))
    at = 0
    for r in rows:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in by_id[r.doc_id]
        at += r.n_tokens
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) > 3
    empty = str(tmp_path / "empty")
    token_store.write_tokens(d.limit(0), empty, vocabulary)
    assert token_store.read_tokens(spark, empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=1500))
def test_elias_fano_select(values):
    values = np.array(sorted(values), np.uint64)
    e = elias_fano.EliasFano(elias_fano.encode(values))
    assert (e.to_array() == values).all() and all(e.select(i) == values[i] for i in range(0, len(values), 97))


def test_elias_fano_is_small():
    bounds = np.cumsum(np.random.default_rng(0).integers(1, 2000, 10_000))
    assert len(elias_fano.encode(bounds)) < 10_000 * 1.8


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("http://EXAMPLE.com/en/7/x?q=1", "example.com", "/en/7/x", "example.com/en/7", "allow"), ("https://a.com/en/1", "a.com", "/en/1", "com/en/", "block"), ("http://com/en/", "com", "/en/", "com/en/", "block"),
    ("http://xcom/en/", "xcom", "/en/", None, "allow"), ("http://my.example.net/de/80", "my.example.net", "/de/80", "example.net/de/8", "block"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no-scheme.com/en/", "", "", None, "allow"),
    ("http://h?x://y/en/", "h", "", None, "allow"), ("http://site.xyz/casino/x", "site.xyz", "/casino/x", None, "block"), ("http://site.xyz/casinox", "site.xyz", "/casinox", None, "allow"), ("http://site.xyz/free-bonus?win=1", "site.xyz", "/free-bonus", None, "block"),
    ("http://site.xyz/free/free/free", "site.xyz", "/free/free/free", None, "allow"), ("http://a.com/EN/", "a.com", "/EN/", None, "allow")])
def test_url_verdicts(spark, url, host, path, rule, verdict):
    d = spark.createDataFrame([(1, url)], "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "rule", "verdict", "c", "_url")})
    r = url_filter.judge_urls(d).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_urls_of_nothing(spark):
    d = spark.createDataFrame([(None, None), (1, "http://x"), (1, "http://x")], "page_id long, url string")
    assert url_filter.judge_urls(d).count() == 3 and url_filter.judge_urls(d.limit(0)).count() == 0


def test_vocabulary_of_a_file(spark):
    strict, soft = url_filter.read_vocabulary(["strict Evil", "5 heavy  # alone it is not enough", "1 light", "", "# none"])
    assert (strict, soft) == (("evil",), {"heavy": 5, "light": 1})
    d = spark.createDataFrame(list(enumerate(["http://x.io/EVIL", "http://x.io/heavy/heavy", "http://x.io/heavy-light", "http://x.io/light"])), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(d, strict=strict, soft=soft).collect()}
    assert got == {0: "block", 1: "allow", 2: "block", 3: "allow"}


def test_rules_are_the_contracts(spark):
    """block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/."""
    contract = {("com", "/en/"): "block", ("example.com", "/en/7"): "allow", ("net", "/de/"): "allow", ("example.net", "/de/8"): "block", ("org", "/es/"): "block"}
    assert {(h, p): verdict for verdict, h, p in url_filter.RULES} == contract
    # Terms that the vocabulary would block do not count where a rule allows, nor the other way round.
    urls = {"http://a.net/de/casino": ("net/de/", "allow"), "http://example.net/de/1": ("net/de/", "allow"), "http://example.net/de/81": ("example.net/de/8", "block"), "http://a.org/es/": ("org/es/", "block"), "http://a.net/en/casino": (None, "block")}
    d = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(d).collect()}
    assert got == dict(enumerate(urls.values()))
    for url, (rule, verdict) in urls.items():  # the SQL says the same
        assert duckdb.execute(f"WITH pages AS (SELECT 1 AS page_id, '{url}' AS url) SELECT rule, verdict FROM ({url_filter.ORACLE_OP2}) q").fetchone() == (rule, verdict)
