"""SimHash near-duplicates: fingerprints, and a trie self-join of the distinct ones.

Words are runs of bytes other than blank and \\t \\n \\v \\f \\r after lower-casing A-Z; a shingle is
``shingle_words`` of them joined by a blank, repeats counted; a text with fewer words is one
shingle, one without words (null and empty too) has fingerprint zero, which links as any
other. A bit is set if it is set in more than half the shingles' XXH64 values (seed 42).

Two fingerprints that differ in at most ``budget`` bits agree in one of ``budget + 1`` bands
of bits; each band's value names a bucket and the trie walk is run inside each bucket. A
bucket beyond ``max_bucket`` distinct fingerprints is dealt again by bands of its other
bits, round by round, so none is ever gathered whole and no pair is lost. As there are only
2,080 other values within two bits of a fingerprint, pairs grow with the number of distinct
fingerprints, not with its square, however large a group of near copies is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import hamming_trie
from quirework.llm.components import connected_components
from quirework.llm.session import materialize, spread_join, table
from quirework.llm.textvec import text_slices

MAX_BUCKET = 1 << 18
_FLUSH = 1 << 16
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """The fingerprint of one text as an unsigned integer."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle_words))) if len(words) >= shingle_words else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, 42) for g in map(b" ".join, grams)], dtype=np.uint64)
    return majority_bits(hashes)


def majority_bits(hashes: np.ndarray) -> int:
    """The number whose bits are those set in more than half of ``hashes`` (uint64); zero for none."""
    columns = hashes.view(np.uint8).reshape(-1, 8)
    # How often each value of each byte stands there tells how often each of its bits is set.
    counts = np.stack([np.bincount(columns[:, k], minlength=256) for k in range(8)]) @ _BYTE_BITS
    return int(np.packbits(2 * counts.ravel() > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle_words: int = 3, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp`` (the fingerprint's bits as a signed long) of every row."""
    kept = [F.col(c) for c in keep]
    source = df.select(*kept, F.col(text_col).alias("_text"))
    schema = source.select(*keep).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "_text"):
                fps = np.array([fingerprint(t, shingle_words) for t in b.column(len(keep)).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(fps.view(np.int64))], [*keep, "fp"])

    return source.mapInArrow(run, schema)


def _band_masks(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` in ``parts`` masks of nearly equal size, highest first."""
    bits = [i for i in range(63, -1, -1) if free >> i & 1]
    cuts = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << i for i in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _deal(rows: DataFrame, masks: list[int], budget: int) -> tuple[DataFrame, list[int]]:
    """Each row once for every band of the bits that its bucket leaves free, and the masks now fixed.

    Rows have fixed (mask), value and fp. There are at most (budget + 1) ** rounds masks.
    """
    out, new = [], []
    for fixed in masks:
        for band in _band_masks(~fixed & (1 << 64) - 1, budget + 1):
            new.append(fixed | band)
            out.append(F.struct(F.lit(_signed(fixed)).cast("long").alias("was"), F.lit(_signed(fixed | band)).cast("long").alias("fixed")))
    dealt = rows.withColumn("b", F.explode(F.array(*out))).where("b.was = fixed")
    return dealt.select(F.col("b.fixed").alias("fixed"), F.col("fp").bitwiseAND(F.col("b.fixed")).alias("value"), "fp"), sorted(set(new))


def _join_buckets(rows: DataFrame, budget: int) -> DataFrame:
    """Pairs (a, b) of fingerprints within the budget that share a bucket (fixed, value)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3

        def pairs(fixed, value, fp):
            # Rows come sorted by (fixed, value, fp) as signed numbers; the walk needs unsigned order within a bucket.
            codes = fp.view(np.uint64)
            order = np.lexsort((codes, value, fixed))
            fixed, value, codes = fixed[order], value[order], codes[order]
            edge = np.flatnonzero(np.concatenate([[True], (fixed[1:] != fixed[:-1]) | (value[1:] != value[:-1])]))
            for i, j in hamming_trie.self_join(codes, edge, np.append(edge[1:], len(codes)), budget):
                yield pa.RecordBatch.from_arrays([pa.array(codes[i].view(np.int64)), pa.array(codes[j].view(np.int64))], ["a", "b"])

        for b in batches:
            held = [np.concatenate([h, np.asarray(c)]) for h, c in zip(held, b.columns)]
            if len(held[0]) < _FLUSH:
                continue
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            cut = int(np.argmax(last))  # the last bucket may go on in the next batch
            if cut:
                yield from pairs(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield from pairs(*held)

    placed = rows.select("fixed", "value", "fp").repartition(parts, "fixed", "value").sortWithinPartitions("fixed", "value", "fp")
    return placed.mapInArrow(run, "a long, b long")


def hamming_pairs(codes: DataFrame, budget: int, column: str = "fp", max_bucket: int = MAX_BUCKET) -> DataFrame:
    """All pairs (a, b) of distinct values of ``column`` at most ``budget`` bits apart, each once."""
    if max_bucket < 1 << (budget + 1):
        raise ValueError("max_bucket is too small for the budget")
    whole = codes.select(F.col(column).alias("fp")).where("fp IS NOT NULL").distinct().withColumns({"fixed": F.lit(0).cast("long"), "value": F.lit(0).cast("long")})
    rows, masks = _deal(whole, [0], budget)
    found = None
    while True:
        # Only the names of buckets of over max_bucket rows are kept here.
        hot = materialize(rows.groupBy("fixed", "value").count().where(F.col("count") > max_bucket).select("fixed", "value"), "hot-buckets")
        n_hot = hot.count()
        cool = rows.join(hot, ["fixed", "value"], "left_anti") if n_hot else rows
        pairs = _join_buckets(cool, budget)
        found = pairs if found is None else found.union(pairs)
        if not n_hot:
            return found.distinct()
        dealt, masks = _deal(rows.join(hot, ["fixed", "value"], "left_semi"), masks, budget)
        rows = materialize(dealt, "dealt-buckets")


def near_duplicates(df: DataFrame, shingle_words: int = 3, budget: int = 2, text_col: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = (), max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row for each row of ``df``: ``id_col``, the columns ``keep``, fp and component_id.

    component_id is the smallest id reachable over links, null if no row of the component
    has an id. Repeated rows and ids stay as they are.
    """
    marked = materialize(fingerprints(df, shingle_words, text_col, (id_col, *keep)), "fingerprints")
    classes = materialize(print_groups(marked.select(F.col(id_col).alias("id"), "fp"), budget, "id", max_bucket).select("fp", "n", "component_id"), "fingerprint-classes")
    # Columns asked for keep their names, whatever they are.
    rows = marked.select("fp", F.struct(id_col, *keep).alias("row"))
    # A fingerprint may stand for a third of all rows.
    return spread_join(rows, classes, ["fp"]).select(*[F.col("row")[c].alias(c) for c in (id_col, *keep)], "fp", "component_id")


def print_groups(marked: DataFrame, budget: int, id_col: str, max_bucket: int) -> DataFrame:
    """Columns fp, part (the smallest fingerprint reachable), least (smallest id of fp), n (its rows) and component_id of every fingerprint."""
    distinct = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("n")), "distinct-fingerprints")
    parts = connected_components(hamming_pairs(distinct, budget, max_bucket=max_bucket))
    named = distinct.join(parts, distinct["fp"] == parts["node"], "left").select("fp", F.coalesce("component", "fp").alias("part"), "least", "n")
    least = named.groupBy("part").agg(F.min("least").alias("component_id"))
    return named.join(least, "part").select("fp", "part", "least", "n", "component_id")


def one_of_each(df: DataFrame, shingle_words: int = 3, budget: int = 2, text_col: str = "text", id_col: str = "doc_id", max_bucket: int = MAX_BUCKET, similarity: float | None = None) -> DataFrame:
    """One row of ``df`` for each component: that of its smallest id, and one that has no id where none has. All columns stay, whatever their names.

    With ``similarity`` texts link by the real similarity of their shingles: fingerprints within
    the budget propose pairs, and so does ``near_copies`` for pairs that differ in more bits.
    """
    if similarity is not None:
        from quirework.llm import near_copies

        return near_copies.one_of_each(df, similarity, shingle_words, budget, text_col, id_col, max_bucket)
    # Nulls are told apart by a flag, so that one dealing of the texts by (fp, known, id) serves the join and the choice among repeated rows.
    known = F.col(id_col).isNotNull()
    packed = df.select(F.struct(*df.columns).alias("row"), known.alias("known"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(text_col).alias("text"))
    marked = materialize(fingerprints(packed, shingle_words, "text", ("row", "known", "id")), "fingerprinted")
    classes = print_groups(marked.select(F.when(F.col("known"), F.col("id")).alias("id"), "fp"), budget, "id", max_bucket)
    # The smallest of the fingerprints that the smallest id has, so one of repeated ids is taken as well.
    own = classes.where(F.col("least").eqNullSafe(F.col("component_id"))).groupBy("part", "component_id").agg(F.min("fp").alias("fp"))
    chosen = own.select("fp", F.col("component_id").isNotNull().alias("known"), F.coalesce("component_id", F.lit(0)).alias("id"))
    # Rows of one id and fingerprint: repeated ones, or near copies under one id.
    return marked.join(chosen, ["fp", "known", "id"], "left_semi").dropDuplicates(["fp", "known", "id"]).select("row.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
