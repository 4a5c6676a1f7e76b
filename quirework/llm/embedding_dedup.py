"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

A rotation is learned on a bounded sample (``SAMPLE_ROWS`` vectors, those of smallest hash)
so that the signs of the rotated, centred unit vectors make balanced binary codes of
``BITS`` bits. A table is a choice of some bits; vectors that agree in all of them share a
bucket. The bits of a table grow with the logarithm of the number of vectors, so a bucket holds
about ``BUCKET`` unrelated ones at any size. The number of tables is measured: as many as find
``RECALL`` of pairs made from the sample whose cosine is just ``min_cosine``, by noise in any
direction and by noise along the data, whichever needs more.

Pairs that share a bucket and whose codes differ in at most ``RADIUS`` bits are reranked by cosine
in double precision of the original vectors. A pair belongs to the first table it shares a
bucket of, so none is made twice. Where a bucket has more than ``DENSE`` pairs for each of its
vectors, as groups of near copies have, its vectors are gathered as blocks and multiplied
there; only the number of links of each vector and links that join what is linked leave the
block, so rows stay in proportion to vectors however large a group of near copies is.

Null, zero and empty vectors and those with null or non-finite components link with
nothing; vectors of different length do not link. Equal vectors are handled as one with a
count, so a third of all rows may be one vector. A bucket of over ``BLOCK_ROWS`` vectors is
compared in blocks, every pair of blocks in a group of its own. Columns beyond those named play
no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.components import connected_components
from quirework.llm.grouping import group_starts, roots, unite, whole_groups
from quirework.llm.session import materialize, partitions, spread_join, table

BITS, RADIUS = 128, 40
BUCKET, RECALL, MAX_TABLES = 32, 0.98, 512
SAMPLE_ROWS = 20_000
BLOCK_ROWS = 2_000
DENSE = 4
ROUNDS = 30


class Rotation:
    """Mean, projection and thresholds of the code bits."""

    def __init__(self, mean: np.ndarray, projection: np.ndarray, cuts: np.ndarray):
        self.mean, self.projection, self.cuts = mean, projection, cuts

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Codes of unit vectors (rows), 64 bits to a column."""
        bits = (unit - self.mean) @ self.projection > self.cuts
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").astype(np.uint64)


def learn_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 7) -> Rotation:
    """Iterative quantisation: alternate codes = signs, rotation = the orthogonal map nearest to them.

    Codes longer than the vectors take several rotations from different starts side by side.
    Each bit is cut at the sample's median, which balances it.
    """
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    parts, left = [], bits
    while left > 0:
        width = min(dim, left)
        top = axes[:, ::-1][:, :width]
        v = centred @ top
        r = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(rounds):
            u, _, wt = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
            r = wt.T @ u.T
        parts.append(top @ r)
        left -= width
    projection = np.concatenate(parts, axis=1)
    return Rotation(mean, projection, np.median(centred @ projection, axis=0))


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    # Scaled by the largest component first, so that squares neither overflow nor vanish; -0.0 becomes 0.0.
    scaled = F.transform("v", lambda x: x / F.col("m") + F.lit(0.0))
    return df.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & fine).withColumn("m", F.array_max(F.transform("v", F.abs))).select("id", scaled.alias("v"))


def choose_tables(rotation: Rotation, unit: np.ndarray, rows: int, min_cosine: float, seed: int = 11) -> np.ndarray:
    """Masks (tables by words of the code) for ``rows`` vectors: how many bits by their number, how many tables by the recall they reach on pairs of just ``min_cosine``."""
    width = int(np.clip(np.ceil(np.log2(max(rows, 1) / BUCKET)), 6, 48))
    rng = np.random.default_rng(seed)
    picks = np.argsort(rng.random((MAX_TABLES, BITS)), axis=1)[:, :width]
    bits = np.zeros((MAX_TABLES, BITS), np.uint8)
    np.put_along_axis(bits, picks, 1, axis=1)
    masks = np.packbits(bits, axis=1, bitorder="little").view("<u8").astype(np.uint64)
    x = unit[rng.integers(0, len(unit), 4000)]
    need = 1
    for noise in (rng.standard_normal(x.shape), unit[rng.integers(0, len(unit), 4000)] - unit[rng.integers(0, len(unit), 4000)]):
        across = noise - (noise * x).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(across, axis=1)
        ok = size > 1e-9
        if not ok.any():
            continue
        y = min_cosine * x[ok] + np.sqrt(max(1 - min_cosine**2, 0.0)) * across[ok] / size[ok, None]
        differ = rotation.codes(x[ok]) ^ rotation.codes(y)
        met = np.zeros(len(differ), bool)
        for t in range(MAX_TABLES):
            met |= ((differ & masks[t]) == 0).all(axis=1)
            if met.mean() >= RECALL:
                break
        need = max(need, t + 1)
    return masks[:need]


def near_vectors(df: DataFrame, min_cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", radius: int = RADIUS, block_rows: int = BLOCK_ROWS, dense: int = DENSE) -> DataFrame:
    """One row for each row of ``df``: id_col, n_links, component_id, kept.

    Rows without id count as vectors that others link to; component_id is the smallest id
    that is not null, and a row alone has its own. Repeated rows are vectors of their own.
    """
    spark = df.sparkSession
    usable = _usable(df, id_col, vector_col)
    # Classes of equal direction as far as doubles tell: equal scaled vectors, told apart by 128 bits of hash and then numbered.
    keyed = usable.select("id", "v", F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g"))
    members = materialize(keyed.select("id", "h", "g"), "vector-members")
    grouped = keyed.groupBy("h", "g").agg(F.min("id").alias("least"), F.count("*").alias("n"), F.any_value("v").alias("v"))
    classes = materialize(grouped.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    links = dense_counts = None
    for dim, rows in classes.groupBy(F.size("v").alias("d")).agg(F.count("*")).collect():  # lengths, as a rule one
        pairs, joined, counts = _class_links(classes.where(F.size("v") == dim), dim, rows, min_cosine, radius, block_rows, dense)
        edges = pairs.withColumn("counts", F.lit(True)).union(joined.withColumn("counts", F.lit(False)))
        links = edges if links is None else links.union(edges)
        dense_counts = counts if dense_counts is None else dense_counts.union(counts)
    if links is None:
        links, dense_counts = spark.createDataFrame([], "a long, b long, counts boolean"), spark.createDataFrame([], "cls long, near long")
    links = materialize(links, "vector-links")
    single = links.where("counts").select("a", "b")
    both = single.union(single.select(F.col("b").alias("a"), F.col("a").alias("b")))
    one_by_one = both.join(classes.select(F.col("cls").alias("b"), "n"), "b").select(F.col("a").alias("cls"), F.col("n").alias("near"))
    degrees = one_by_one.union(dense_counts).groupBy("cls").agg(F.sum("near").alias("near"))
    parts = connected_components(links)
    named = classes.join(degrees, "cls", "left").join(parts, classes["cls"] == parts["node"], "left").select("h", "g", "n", "least", (F.coalesce("near", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "cls").alias("part"))
    least = named.groupBy("part").agg(F.min("least").alias("component_id"))
    result = materialize(named.join(least, "part").select("h", "g", "n", "n_links", "component_id"), "vector-results")
    linked = spread_join(members, result, ["h", "g"]).select("id", "n_links", "component_id")
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    alone = df.where(~F.coalesce(fine, F.lit(False))).select(F.col(id_col).alias("id"), F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id").isNotNull() & F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"))


def _class_links(classes: DataFrame, dim: int, rows: int, min_cosine: float, radius: int, block_rows: int, dense: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (a, b) between classes outside dense blocks; links that join what dense blocks link; cls and near, the vectors linked to a class within them."""
    spark = classes.sparkSession
    sample = classes.select("h", "v").orderBy("h").limit(min(SAMPLE_ROWS, max(256, (32 << 20) // (8 * dim)))).toArrow()
    x = np.array(sample.column("v").combine_chunks().values, dtype=np.float64).reshape(-1, dim)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotation = learn_rotation(x)
    masks = choose_tables(rotation, x, rows, min_cosine)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quirework.llm.textvec import mix

        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                v = np.asarray(b.column(1).flatten(), dtype=np.float64).reshape(-1, dim)
                codes = rotation.codes(v / np.linalg.norm(v, axis=1, keepdims=True))
                for t, mask in enumerate(masks):
                    key = mix(mix((codes[:, 0] & mask[0]) + np.uint64(t)) + (codes[:, 1] & mask[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), t, np.int32)), pa.array(key.view(np.int64)), b.column(0), *[pa.array(c) for c in np.ascontiguousarray(codes.T).view(np.int64)]], ["t", "key", "cls", "c0", "c1"])

    entries = materialize(classes.select("cls", "v").mapInArrow(enter, "t int, key long, cls long, c0 long, c1 long"), "hamming-tables")
    # Large buckets in blocks: a row goes to every pair of blocks that holds its own. A bucket of one row has no pairs.
    sizes = materialize(entries.groupBy("t", "key").count().where("count > 1").select("t", "key", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks")), "bucket-sizes")
    dealt = entries.join(sizes, ["t", "key"]).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    placed = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "c0", "c1")
    by_bucket = lambda d: d.repartition(partitions(spark), "t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
    found = materialize(by_bucket(placed).mapInArrow(lambda it: _bucket_pairs(it, masks, radius, dense), "a long, b long, t int, key long, i int, j int, own int"), "bucket-pairs")
    vectors = classes.select("cls", "n", "v")
    va, vb = vectors.select(F.col("cls").alias("a"), F.col("v").alias("va")), vectors.select(F.col("cls").alias("b"), F.col("v").alias("vb"))

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                x, y = (np.asarray(b.column(k).flatten(), dtype=np.float64).reshape(-1, dim) for k in (2, 3))
                cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(cosine >= min_cosine)) for c in b.columns[:2]], ["a", "b"])

    near = found.where("b IS NOT NULL").select("a", "b").join(va, "a").join(vb, "b").select("a", "b", "va", "vb").mapInArrow(rerank, "a long, b long")
    inside = by_bucket(found.where("b IS NULL").select("t", "key", "i", "j", "own", F.col("a").alias("cls")).join(vectors, "cls").select("t", "key", "i", "j", "own", "cls", "n", "v"))
    blocks = materialize(inside.mapInArrow(lambda it: _dense_links(it, rotation, masks, dim, min_cosine), "cls long, other long, near long"), "dense-links")
    return near, blocks.where("other <> cls").select(F.col("cls").alias("a"), F.col("other").alias("b")), blocks.select("cls", "near")


def _elsewhere(masks: np.ndarray, t: np.ndarray, d0: np.ndarray, d1: np.ndarray) -> np.ndarray:
    """Whether pairs of table ``t`` whose codes differ in d0 and d1 share a bucket of a table before it."""
    out = np.zeros(np.broadcast(t, d0).shape, bool)
    for k in range(int(t.max()) if t.size else 0):
        out |= (k < t) & ((d0 & masks[k, 0]) == 0) & ((d1 & masks[k, 1]) == 0)
    return out


def _bucket_pairs(batches: Iterator[pa.RecordBatch], masks: np.ndarray, radius: int, dense: int) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: pairs (a, b) within the radius, and members a (b null) of groups with over ``dense`` pairs a member."""
    names = ["a", "b", "t", "key", "i", "j", "own"]
    for whole in whole_groups(batches, 4):
        t, key, i, j, own, cls, c0, c1 = (np.asarray(c) for c in whole.columns)
        c0, c1 = c0.view(np.uint64), c1.view(np.uint64)
        edge = group_starts(whole, 4)
        size = np.diff(np.append(edge, len(t)))
        group = np.repeat(np.arange(len(edge)), size)
        # Row r of a group meets the rows after it.
        after = np.repeat(edge + size, size) - np.arange(len(t)) - 1
        total = np.cumsum(after)
        made: list[tuple[np.ndarray, np.ndarray]] = []
        count = np.zeros(len(edge), np.int64)
        at = 0
        while at < len(t):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 19), "right")))
            n = after[at:end]
            x = np.repeat(np.arange(at, end), n)
            y = x + 1 + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            at = end
            d0, d1 = c0[x] ^ c0[y], c1[x] ^ c1[y]
            ok = (np.bitwise_count(d0) + np.bitwise_count(d1) <= radius) & ((i[x] == j[x]) | (own[x] != own[y]))
            x, y, d0, d1 = x[ok], y[ok], d0[ok], d1[ok]
            first = ~_elsewhere(masks, t[x], d0, d1)
            x, y = x[first], y[first]
            count += np.bincount(group[x], minlength=len(edge))
            # Pairs of a group that turned out dense are not kept.
            thin = count[group[x]] <= dense * size[group[x]]
            made.append((x[thin], y[thin]))
        full = count > dense * size
        x, y = (np.concatenate(p) for p in zip(*made))
        thin = ~full[group[x]]
        x, y = x[thin], y[thin]
        if len(x):
            void = pa.nulls(len(x), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(cls[x]), pa.array(cls[y]), void, pa.nulls(len(x), pa.int64()), void, void, void], names)
        m = np.flatnonzero(full[group])
        if len(m):
            yield pa.RecordBatch.from_arrays([pa.array(cls[m]), pa.nulls(len(m), pa.int64()), *[pa.array(c[m]) for c in (t, key, i, j, own)]], names)


def _dense_links(batches: Iterator[pa.RecordBatch], rotation: Rotation, masks: np.ndarray, dim: int, min_cosine: float) -> Iterator[pa.RecordBatch]:
    """cls, other (a class it is joined to, or itself) and near (vectors linked to it) of every row of every dense group."""
    for whole in whole_groups(batches, 4):
        edge = group_starts(whole, 4)
        for a, z in zip(edge, np.append(edge[1:], whole.num_rows)):
            b = whole.slice(a, z - a)
            m = b.num_rows
            t, i, j, own, cls, n = (np.asarray(b.column(c)) for c in (0, 2, 3, 4, 5, 6))
            x = np.asarray(b.column(7).flatten(), dtype=np.float64).reshape(m, dim)
            x = x / np.sqrt((x * x).sum(axis=1))[:, None]
            codes = rotation.codes(x)
            near, joined = np.zeros(m, np.int64), np.arange(m)
            for lo in range(0, m, 256):  # a tile of rows at a time
                hi = min(lo + 256, m)
                linked = x[lo:hi] @ x.T >= min_cosine
                if i[0] != j[0]:
                    linked &= own[lo:hi, None] != own[None, :]
                linked[np.arange(hi - lo), np.arange(lo, hi)] = False
                r, c = np.nonzero(linked)
                mine = ~_elsewhere(masks, t[:1], codes[lo + r, 0] ^ codes[c, 0], codes[lo + r, 1] ^ codes[c, 1])
                r, c = lo + r[mine], c[mine]
                near += np.bincount(r, n[c], minlength=m).astype(np.int64)
                unite(joined, r, c)
            top = roots(joined)
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(cls[top]), pa.array(near)], ["cls", "other", "near"])


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE_OP4 = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND list_count(e) = len(e) AND len(list_filter(e, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT node, min(other) AS least FROM reach GROUP BY node),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(comp.least, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(comp.least, vec_id)) AS kept
FROM v LEFT JOIN deg ON a = vec_id LEFT JOIN comp ON node = vec_id
"""
