"""Token ids of a corpus in binary shards with Elias-Fano document boundaries.

A shard file holds, little-endian: magic ``QTS2``, id width in bytes (2 or 4), number of
documents, number of documents whose id is null (they come first), smallest doc_id, length and
CRC-32 of what follows, the Elias-Fano block of the n+1 boundaries, that of the other doc_ids
less the smallest, and the concatenated ids. Spark's committer puts the shards in place, so a
lost executor leaves no half-written file; the writer ends each file with one line feed, which
readers ignore. A reader refuses a file whose checksum differs.

Documents are in ascending doc_id order over the shards (null first, ties in any order).
Null and empty texts hold the end id alone. Other columns are not stored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.llm import elias_fano
from quirework.llm.session import fresh_path, materialize, table
from quirework.llm.textvec import text_slices

SHARD_BYTES = 8 << 20
#: Words and pieces of words cached by a worker, and the longest that is.
CACHE_WORDS, CACHE_PIECES, CACHE_CHARS = 100_000, 500_000, 40
MAX_VOCABULARY_BYTES = 64 << 20
_HEAD = struct.Struct("<4sBQQqQI")
_CUT = re.compile(r"(?<=\w)(?=[ \n])")
#: How the byte-level tokenizer splits a text (fixed pattern).
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: From this character on classes may differ between Unicode versions, so the library splits.
_STABLE_BELOW = "\u0500"
_RARE = re.compile(f"[{_STABLE_BELOW}-\U0010ffff]")


def _class_of(kind: str) -> str:
    """All stable characters of a category, as they stand in a set of a pattern."""
    import unicodedata

    return "".join(re.escape(chr(c)) for c in range(ord(_STABLE_BELOW)) if unicodedata.category(chr(c))[0] == kind)


def _stable_pieces():
    """A function that splits texts of stable characters as _PIECE does."""
    letter, number, blank = _class_of("L"), _class_of("N"), r"\t-\r \x85\xa0"
    return re.compile(f" ?[{letter}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{number}]+| ?[^{blank}{letter}{number}]+|[{blank}]+(?![^{blank}])|[{blank}]+").findall


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class _Filled(dict):
    """A dictionary that makes what it lacks."""

    def __init__(self, make):
        self._make = make

    def __missing__(self, key):
        return self._make(key)


class CachedTokenizer:
    """A byte-level tokenizer of the tokenizers library with bounded caches of words and of pieces.

    A text of stable characters is split by the tokenizer's own pattern and the pieces not yet
    seen go to the library's BPE model. In others the pattern still ends a match between a
    non-blank and the blank after it, so ids of a text are those of its parts between such
    places, put together; a part that is odd (long, of rare scripts, with runs of blanks, with a
    special token) goes to the library's encoder whole.
    """

    def __init__(self, vocabulary: bytes, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_buffer(vocabulary)
        self._tokenizer.encode_special_tokens = special_as_text
        told = json.loads(vocabulary)
        self._specials = [] if special_as_text else [t["content"] for t in told.get("added_tokens") or []]
        size = self._tokenizer.get_vocab_size(True)
        self.width = 2 if size <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        pre = told.get("pre_tokenizer") or {}
        self._simple = told.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self._tokenize, self._split = self._tokenizer.model.tokenize, regex.compile(_PIECE).findall
        self._letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self._packed = [i.to_bytes(self.width, "little") for i in range(size)]
        self._words, self._pieces = _Filled(self._word), _Filled(self._piece)
        self._stable = _stable_pieces()

    @staticmethod
    def parts(text: str) -> list[str]:
        # Its words joined by single blanks give the text, line feeds apart: no white space stands together or at the ends, and no other is there.
        if "\0" in text or " ".join(text.split()) != text.replace("\n", " "):
            out, at = [], 0
            for m in _CUT.finditer(text):
                out.append(text[at : m.start()])
                at = m.start()
            return [*out, text[at:]]
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")

    def _piece(self, piece: str) -> bytes:
        if piece.isascii():
            rest = piece[1:]
            letters = "\u0120" + rest if rest.isalnum() and piece[0] == " " else piece if piece.isalnum() else piece.translate(self._letters)
        else:
            letters = piece.encode().decode("latin-1").translate(self._letters)
        packed = self._packed
        made = b"".join([packed[t.id] for t in self._tokenize(letters)])
        if len(piece) <= CACHE_CHARS:
            self._pieces[piece] = made
        return made

    def _word(self, word: str) -> bytes:
        """Ids of a part; kept if it is short and begins with one blank at most."""
        if not word:
            return b""
        first, last = word[0], word[-1]
        if len(word) > CACHE_CHARS or not self._simple or last.isspace() or "  " in word or first not in " \n" and first.isspace() or not (word.isascii() or max(word) < _STABLE_BELOW) or any(t in word for t in self._specials):
            return np.array(self._tokenizer.encode(word, add_special_tokens=False).ids, dtype=self.kind).tobytes()
        pieces = self._split(word)
        made = self._pieces[pieces[0]]
        for p in pieces[1:]:
            made += self._pieces[p]
        self._words[word] = made
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self._words) > CACHE_WORDS:
            self._words.clear()
        if len(self._pieces) > CACHE_PIECES:
            self._pieces.clear()
        word, piece, split = self._words.__getitem__, self._pieces.__getitem__, self._stable
        out = []
        for t in texts:
            plain = self._simple and (t.isascii() or not _RARE.search(t)) and not any(x in t for x in self._specials)
            out.append(b"".join(map(piece, split(t)) if plain else map(word, self.parts(t))))
        return out


_tokenizers: dict[tuple[int, bool], CachedTokenizer] = {}


def _tokenizer(content: bytes, special_as_text: bool) -> CachedTokenizer:
    key = hash(content), special_as_text
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = CachedTokenizer(content, special_as_text)
    return _tokenizers[key]


def pack_shard(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """doc_ids in ascending order, null first; ids of each document as little-endian bytes."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], dtype=np.int64)
    base = int(known[0]) if len(known) else 0
    bounds = np.concatenate([[0], np.cumsum([len(x) // width for x in ids])])
    body = b"".join([elias_fano.encode(bounds), elias_fano.encode((known - base).astype(np.uint64)), *ids])
    return _HEAD.pack(b"QTS2", width, len(ids), nulls, base, len(body), zlib.crc32(body)) + body


class Shard:
    """One shard's content; ``ids(i)`` finds its place by select."""

    def __init__(self, data: bytes):
        magic, self.width, self.count, self.nulls, self._base, size, told = _HEAD.unpack_from(data)
        if magic != b"QTS2":
            raise ValueError("not a token shard")
        if zlib.crc32(memoryview(data)[_HEAD.size : _HEAD.size + size]) != told:
            raise ValueError("a damaged token shard")
        self.bounds = elias_fano.EliasFano(data, _HEAD.size)
        self._doc_ids = elias_fano.EliasFano(data, self.bounds.end)
        self.n_ids = self.bounds.select(self.count)
        self.all_ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, self._doc_ids.end)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self._doc_ids.to_array().astype(np.int64) + self._base).tolist()

    def ids(self, i: int) -> np.ndarray:
        return self.all_ids[self.bounds.select(i) : self.bounds.select(i + 1)]


def write_tokens(df: DataFrame, path: str, vocabulary_path: str, end_id: int = 0, shard_bytes: int = SHARD_BYTES, text_col: str = "text", id_col: str = "doc_id", special_as_text: bool = True) -> None:
    """Encode every row's text and write the shards to ``path``.

    With ``special_as_text`` the strings of special tokens are ordinary text wherever they
    stand, so that no document can forge a marker; without it they get their own ids.
    """
    spark = df.sparkSession
    with open(vocabulary_path, "rb") as f:
        content = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary_path} exceeds {MAX_VOCABULARY_BYTES} bytes")
    vocabulary = spark.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary.value, special_as_text)
        end = np.array([end_id], dtype=tokenizer.kind).tobytes()
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack_shard(doc_ids, ids, tokenizer.width)], pa.binary())], ["shard"])

        for whole in batches:
            for b in text_slices(whole, "_text"):
                new = [x + end for x in tokenizer.encode([t or "" for t in b.column(1).to_pylist()])]
                for d, x in zip(b.column(0).to_pylist(), new):
                    if ids and held + len(x) > shard_bytes:
                        yield shard()
                        doc_ids, ids, held = [], [], 0
                    doc_ids.append(d)
                    ids.append(x)
                    held += len(x)
        if ids:
            yield shard()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).repartitionByRange(parts, "_id").sortWithinPartitions("_id")
    shards = ordered.mapInArrow(run, "shard binary")
    # A row's bytes go out as they are, each row to a file of its own, in the order of the rows.
    shards.select(F.col("shard").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                shard = Shard(data.as_buffer())
                bounds = shard.bounds.to_array().astype(np.int64)
                crcs = [zlib.crc32(shard.all_ids[a:z].astype("<u4").tobytes()) for a, z in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * shard.count, pa.string()), pa.array(shard.doc_ids(), pa.int64()), pa.array(bounds[:-1]), pa.array(bounds[1:] - bounds[:-1]), pa.array(crcs, pa.int64())],
                    ["file", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    docs = materialize(files.mapInArrow(run, "file string, doc_id long, local_start long, n_tokens long, ids_crc32 long"), "token-docs")
    part = F.regexp_extract("file", r"part-(\d+)-", 1).cast("long")
    number = F.regexp_extract("file", r"-c(\d+)\D*$", 1).cast("long")
    # Running totals in two steps: over the shards of each part, and over the parts, of which there are as many as write tasks.
    sizes = docs.groupBy("file").agg(F.sum("n_tokens").alias("total")).select("file", part.alias("part"), number.alias("number"), "total")
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("total").alias("total")).select("part", F.coalesce(F.sum("total").over(ahead(Window.orderBy("part"))), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("total").over(ahead(Window.partitionBy("part").orderBy("number"))), F.lit(0))
    bases = sizes.withColumn("within", within).join(parts, "part").select("file", (F.col("before") + F.col("within")).alias("base"))
    return docs.join(bases, "file").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path)
