"""Byte-level BPE encoding and decoding by a local rank file.

Null texts count as empty; an empty text has no ids. Row order, repeated rows and columns
beyond those named play no part. Texts of any length are encoded whole: a long one is cut
only where a match of the splitting pattern ends in any case (between a word character and
the blank or line feed after it), so the ids are those of the text in one piece. The library's
matcher overflows on very long runs of white space; texts that hold one are split by the same
pattern here, and each match is encoded by itself.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from quirework.llm.session import table
from quirework.llm.textvec import text_slices

#: Characters encoded at once.
PIECE_CHARS = 1 << 16
#: The rank file is broadcast; a larger one is refused.
MAX_RANK_BYTES = 64 << 20
_SAFE = re.compile(r"(?<=\w)(?=[ \n])")
#: A run of white space too long for the library's matcher (it overflows between 300,000 and a million).
_LONG_BLANK = re.compile(r"\s{65536}")


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Consecutive parts of ``text`` of ``limit`` characters or little more, cut at safe places only."""
    at = 0
    while len(text) - at > limit:
        cut = _SAFE.search(text, at + limit)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Codec:
    """tiktoken's encoding over ranks given as the content of a rank file."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex
        import tiktoken

        # White space as the library's matcher has it, which leaves out the separators U+001C to U+001F.
        self._matches = regex.compile(pattern.replace("\\s", r"\p{White_Space}").replace("\\S", r"\P{White_Space}")).finditer
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in rank_file.splitlines() if line)}
        self._encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.decimals = [str(i) for i in range(max(ranks.values()) + 1)]

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE_CHARS:
            return self._encoding.encode_ordinary(text)
        if _LONG_BLANK.search(text):
            return [i for m in self._matches(text) for i in self._encoding._encode_single_piece(m.group())]
        return [i for part in pieces(text) for i in self._encoding.encode_ordinary(part)]

    def decode(self, ids: list[int]) -> bytes:
        return self._encoding.decode_bytes(ids)


_codecs: dict[tuple[int, str], Codec] = {}


def _codec(content: bytes, pattern: str) -> Codec:
    key = (hash(content), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content, pattern)
    return _codecs[key]


def _shipped(spark: SparkSession, rank_path: str):
    with open(rank_path, "rb") as f:
        content = f.read(MAX_RANK_BYTES + 1)
    if len(content) > MAX_RANK_BYTES:
        raise ValueError(f"{rank_path} exceeds {MAX_RANK_BYTES} bytes")
    return spark.sparkContext.broadcast(content)


def encode(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``ids`` (array of int) of every row."""
    ranks = _shipped(df.sparkSession, rank_path)
    source = df.select(*keep, F.col(text_col).alias("_text"))
    schema = source.select(*keep).schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for whole in batches:
            for b in text_slices(whole, "_text"):
                ids = [codec.encode(t or "") for t in b.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(ids, pa.list_(pa.int32()))], [*keep, "ids"])

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``decoded`` (the raw bytes of the ids) of every row; null ids give no bytes."""
    ranks = _shipped(df.sparkSession, rank_path)
    source = df.select(*keep, F.col(ids_col).alias("_ids"))
    schema = source.select(*keep).schema.add("decoded", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for b in batches:
            raw = [codec.decode(ids or []) for ids in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(raw, pa.binary())], [*keep, "decoded"])

    return source.mapInArrow(run, schema)


def round_trip(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass, digests in place of ids and bytes.

    Columns ``keep``, n_tokens, ids_sha256 (of decimal ids joined by one space),
    decoded_sha256 and, if asked for, ids (array of int), one row for each row of ``df``.
    """
    ranks = _shipped(df.sparkSession, rank_path)
    source = df.select(*keep, F.col(text_col).alias("_text"))
    schema = source.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        decimal = codec.decimals.__getitem__
        for whole in batches:
            for b in text_slices(whole, "_text"):
                counts, id_digests, byte_digests, all_ids = [], [], [], []
                for text in b.column(len(keep)).to_pylist():
                    ids = codec.encode(text or "")
                    counts.append(len(ids))
                    id_digests.append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                    byte_digests.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                    if with_ids:
                        all_ids.append(ids)
                columns = [*b.columns[: len(keep)], pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(byte_digests, pa.string())]
                if with_ids:
                    columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return source.mapInArrow(run, schema)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
