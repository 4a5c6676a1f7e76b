"""The part of ``simhash`` that links texts by the real similarity of their shingles.

Words are those of ``simhash``; a text's shingles are a set, and a text of fewer words is one
shingle. Two texts link at a Jaccard similarity of ``similarity`` or more; texts without words
(null and empty too) link with one another and with no others. Groups are the components.

Texts of one set of shingles are a class. Classes whose SimHash fingerprints the trie self-join
puts into one component share a bucket. Fingerprints alone cannot reach a similarity of 0.8: such
pairs differ in eight bits on average and hardly ever in two (README has figures), and a budget
that reaches them would compare everything with everything. So classes that agree in one of
``BANDS`` bands of ``ROWS`` minima share a bucket too: at similarity s a pair shares none with
probability (1 - s ** ROWS) ** BANDS, 5e-6 at 0.8. In a bucket neighbours by size are compared, then by a
random order, and in the end all pairs that no links have joined yet and whose minima agree in
``SKETCH`` or more (a pair at 0.8 is six standard deviations above), so texts that share a passage
are not compared whole. Where those are over ``DENSE`` for each of a bucket's classes, the classes
are gathered with their shingles and compared in the task, and only links that join them leave
it, so rows stay in proportion to classes however large a group of near copies is. Buckets of over
``BLOCK_ROWS`` classes or ``BLOCK_SHINGLES`` shingles are dealt: the first two turns look within each
part, the last at every pair of parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from quirework.llm import simhash
from quirework.llm.components import connected_components
from quirework.llm.grouping import group_starts, roots, unite, whole_groups
from quirework.llm.session import drop_staged, materialize, numbered, partitions
from quirework.llm.textvec import SpanHasher, column_bytes, gram_hashes, mix, text_slices, word_bounds

SIMILARITY = 0.8
BANDS, ROWS = 40, 6
#: Minima that agree, as a share of the similarity asked for.
SKETCH = 0.65 / 0.8
DENSE, BLOCK_ROWS, BLOCK_SHINGLES = 4, 1000, 400_000
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: pa.Array, shingle_words: int = 5) -> list[np.ndarray]:
    """The distinct shingles of each text, ascending."""
    buf, offs = column_bytes(texts)
    starts, ends, firsts = word_bounds(buf, offs, _WORD)
    words = SpanHasher(buf)(starts, ends)
    grams, at = gram_hashes(words, firsts, shingle_words)
    cut = np.searchsorted(at, firsts)
    out = []
    for a, z, g, h in zip(firsts, firsts[1:], cut, cut[1:]):
        few = z - a < shingle_words and z > a
        out.append(gram_hashes(words[a:z], np.array([0, z - a]), int(z - a))[0] if few else np.unique(grams[g:h]))
    return out


def bucket_names(shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
    """A name for each band, none for an empty set, and a byte of each minimum."""
    if not len(shingles):
        return np.zeros(0, np.int64), b""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        np.minimum(low, (_FACTORS[:, None] * shingles[None, at : at + 2048]).min(axis=1), out=low)
    name = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        name = mix(name * np.uint64(0x100000001B3) + column)
    return name.view(np.int64), low.astype(np.uint8).tobytes()


def _marked(packed: DataFrame, shingle_words: int) -> DataFrame:
    """row, known and id of every row, with uid (a number of its own), cls (its set of shingles; 0 for none), size, fp (the set's SimHash), the names of its buckets and the sketch."""
    import xxhash

    schema = packed.select("row", "known", "id").schema.add("cls", "long").add("size", "long").add("fp", "long").add("buckets", ArrayType(LongType())).add("sketch", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text"):
                sets = shingle_sets(b.column(3), shingle_words)
                cls = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                prints = np.array([simhash.majority_bits(s) for s in sets], np.uint64).view(np.int64)
                names, sketches = zip(*map(bucket_names, sets))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, names)]), pa.int32()), pa.array(np.concatenate(names)))
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(cls), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints), lists, pa.array(sketches, pa.binary())], ["row", "known", "id", "cls", "size", "fp", "buckets", "sketch"])

    return packed.mapInArrow(run, schema).withColumn("uid", F.monotonically_increasing_id())


def _sorted_by(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, *order)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose bucket the row before or behind has too."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        whole = pa.concat_batches([last, b]) if last is not None else b
        bucket = np.asarray(whole.column(0))
        same = bucket[1:] == bucket[:-1]
        ok = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        # The last row waits for the next one; it is let out only once.
        yield whole.slice(0, whole.num_rows - 1).filter(pa.array(ok[:-1]))
        last = whole.slice(whole.num_rows - 1)
        if ok[-1]:
            yield last
            last = pa.RecordBatch.from_arrays([last.column(0), *[pa.nulls(1, c.type) for c in last.columns[1:]]], schema=last.schema)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows side by side in one part of a bucket that have different labels; rows are bucket, own, cls, label."""
    for whole in whole_groups(batches, 2):
        bucket, own, cls, label = (np.asarray(c) for c in whole.columns[:4])
        ok = (bucket[1:] == bucket[:-1]) & (own[1:] == own[:-1]) & (label[1:] != label[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(cls[:-1][ok]), pa.array(cls[1:][ok])], ["a", "b"])


def _unjoined(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: pairs (a, b) with different labels whose minima agree, and classes a (b null) of groups with too many such pairs; rows are bucket, i, j, size, own, cls, label, sketch, by size within a group."""
    names = ["a", "b", "bucket", "i", "j"]
    for whole in whole_groups(batches, 3):
        edge = group_starts(whole, 3)
        bucket, i, j, size, own, cls, label = (np.asarray(c) for c in whole.columns[:7])
        pairs, dense = [], []
        for a, z in zip(edge, np.append(edge[1:], whole.num_rows)):
            mine = label[a:z]
            if (mine == mine[0]).all():
                continue
            labels, at, count = np.unique(mine, return_inverse=True, return_counts=True)
            sketch = np.frombuffer(b"".join(whole.column(7).slice(a, z - a).to_pylist()), np.uint8).reshape(z - a, -1)
            # Those of the commonest label meet only others; sizes ascend and bound the partners.
            common = count.argmax()
            rest = np.flatnonzero(at != common)
            lo, hi = np.searchsorted(size[a:z], size[a:z][rest] * similarity - 1e-9), np.searchsorted(size[a:z], size[a:z][rest] / similarity + 1e-9, "right")
            made, involved = 0, np.zeros(z - a, bool)
            own_pairs = []
            for r, low, high in zip(rest, lo, hi):
                c = low + np.flatnonzero(at[low:high] != at[r])
                c = c[(at[c] == common) | (c > r)]
                if i[a] != j[a]:
                    c = c[own[a:z][c] != own[a + r]]
                c = c[(sketch[c] == sketch[r]).mean(axis=1) >= SKETCH * similarity]
                if len(c):
                    made += len(c)
                    involved[r] = involved[c] = True
                    if made <= DENSE * (z - a):
                        own_pairs.append((np.full(len(c), cls[a + r]), cls[a:z][c]))
            if made > DENSE * (z - a):
                dense.append(a + np.flatnonzero(involved))
            else:
                pairs += own_pairs
        if pairs:
            x, y = (np.concatenate(p) for p in zip(*pairs))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.nulls(len(x), pa.int64()), pa.nulls(len(x), pa.int32()), pa.nulls(len(x), pa.int32())], names)
        if dense:
            m = np.concatenate(dense)
            yield pa.RecordBatch.from_arrays([pa.array(cls[m]), pa.nulls(len(m), pa.int64()), pa.array(bucket[m]), pa.array(i[m]), pa.array(j[m])], names)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float, shingle_words: int) -> DataFrame:
    """The pairs whose texts are as similar as asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "ta"):
                ok = []
                for s, t in zip(shingle_sets(b.column(2), shingle_words), shingle_sets(b.column(3), shingle_words)):
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    ok.append(both >= similarity * (len(s) + len(t) - both) - 1e-9)
                yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one, other = (texts.select(F.col("cls").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
    once = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return once.join(one, "a").join(other, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def linked_sets(sets: list[np.ndarray], similarity: float, cells: int = 1 << 22) -> np.ndarray:
    """For each set the position of one it is joined to by links, the least of its component."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    names, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), sizes)
    # Shingles of one set alone are in no intersection; the others are taken some columns at a time.
    use = count[column] > 1
    place = np.cumsum(count > 1) - 1
    row, column = row[use], place[column[use]]
    both = np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(1, cells // m)
    for at in range(0, int((count > 1).sum()), width):
        lo, hi = np.searchsorted(column, [at, at + width])
        part = np.zeros((m, width), np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        both += part @ part.T
    joined = np.arange(m)
    for at in range(0, m, 128):
        some = both[at : at + 128]
        r, c = np.nonzero(some >= similarity * (sizes[at : at + 128, None] + sizes[None, :] - some) - 1e-6)
        unite(joined, at + r, c)
    return roots(joined)


def _dense_links(batches: Iterator[pa.RecordBatch], similarity: float, shingle_words: int) -> Iterator[pa.RecordBatch]:
    """Links that join what is linked within each group; rows are bucket, i, j, cls, text."""
    for whole in whole_groups(batches, 3, 256):
        edge = group_starts(whole, 3)
        for a, z in zip(edge, np.append(edge[1:], whole.num_rows)):
            b = whole.slice(a, z - a)
            sets = [s for part in text_slices(b, "text") for s in shingle_sets(part.column(4), shingle_words)]
            cls, top = np.asarray(b.column(3)), linked_sets(sets, similarity)
            ok = top != np.arange(len(top))
            yield pa.RecordBatch.from_arrays([pa.array(cls[ok]), pa.array(cls[top[ok]])], ["a", "b"])


def components(marked: DataFrame, similarity: float, shingle_words: int, budget: int, max_bucket: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """node and component of all classes of ``marked`` (stored) that link to another one."""
    classes = materialize(marked.where("size > 0").groupBy("cls").agg(F.min("uid").alias("uid"), F.first("size").alias("size"), F.first("fp").alias("fp")), "shingle-classes")
    groups = simhash.print_groups(classes.select(F.col("cls").alias("id"), "fp"), budget, "id", max_bucket).select("fp", F.xxhash64(F.lit("fp"), "part").alias("bucket"))
    named = numbered(marked, classes).select(F.explode("buckets").alias("bucket"), "cls", "size")
    buckets = named.union(classes.join(groups, "fp").select("bucket", "cls", "size"))
    shared = materialize(_sorted_by(buckets, ["bucket"]).mapInArrow(_shared, "bucket long, cls long, size long").where("cls IS NOT NULL"), "shared-buckets")
    parts = F.ceil(F.greatest(F.count("*") / block_rows, F.sum("size") / BLOCK_SHINGLES)).cast("int")
    big = materialize(shared.groupBy("bucket").agg(parts.alias("blocks")).where("blocks > 1"), "large-buckets")
    dealt = shared.join(big, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    wanted = classes.join(shared.select("cls").distinct(), "cls", "left_semi").select("uid")
    texts = materialize(numbered(marked, wanted).select("cls", "sketch", "text"), "candidate-texts")
    labels = links = None
    for turn in ("neighbours", "shuffled", "all"):
        rows = dealt.withColumn("label", F.col("cls"))
        if labels is not None:
            rows = dealt.join(labels, dealt["cls"] == labels["node"], "left").select(*dealt.columns, F.coalesce("component", "cls").alias("label"))
        if turn == "all":
            mixed = rows.groupBy("bucket").agg((F.min("label") < F.max("label")).alias("mixed")).where("mixed").select("bucket")
            placed = rows.join(mixed, "bucket", "left_semi").join(texts.select("cls", "sketch"), "cls").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            placed = placed.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "size", "own", "cls", "label", "sketch")
            found = materialize(_sorted_by(placed, ["bucket", "i", "j"], "size", "cls").mapInArrow(lambda it: _unjoined(it, similarity), "a long, b long, bucket long, i int, j int"), "unjoined")
            pairs = found.where("b IS NOT NULL").select("a", "b")
            inside = found.where("b IS NULL").select("bucket", "i", "j", F.col("a").alias("cls")).join(texts.select("cls", "text"), "cls").select("bucket", "i", "j", "cls", "text")
            dense = _sorted_by(inside, ["bucket", "i", "j"]).mapInArrow(lambda it: _dense_links(it, similarity, shingle_words), "a long, b long")
            new = _verified(pairs, texts, similarity, shingle_words).union(dense)
        else:
            order = F.col("size") if turn == "neighbours" else F.xxhash64("cls")
            by = _sorted_by(rows.select("bucket", "own", "cls", "label", order.alias("order")), ["bucket", "own"], "order", "cls")
            new = _verified(by.mapInArrow(_neighbours, "a long, b long"), texts, similarity, shingle_words)
        new = materialize(new, "near-links")
        links = new if links is None else links.union(new)
        labels = materialize(connected_components(links), "near-components")
    drop_staged(shared)
    drop_staged(texts)
    return labels


def one_of_each(df: DataFrame, similarity: float = SIMILARITY, shingle_words: int = 5, budget: int = 2, text_col: str = "text", id_col: str = "doc_id", max_bucket: int = simhash.MAX_BUCKET, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row of ``df`` for each group, as ``simhash.one_of_each`` chooses them."""
    known = F.col(id_col).isNotNull()
    packed = df.select(F.struct(*df.columns).alias("row"), known.alias("known"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(text_col).alias("text"))
    marked = materialize(_marked(packed, shingle_words), "shingled")
    labels = components(marked.withColumn("text", F.col("row")[text_col]), similarity, shingle_words, budget, max_bucket, block_rows)
    # A row without id comes after all that have one; rows are told apart by their own numbers, so no key is hot.
    first = marked.groupBy("cls").agg(F.min(F.struct((~F.col("known")).alias("none"), "id", "uid")).alias("first"))
    named = first.join(labels, first["cls"] == labels["node"], "left").select(F.coalesce("component", "cls").alias("part"), "first")
    chosen = named.groupBy("part").agg(F.min("first").alias("first")).select(F.col("first.uid").alias("uid"))
    return numbered(marked, chosen).select("row.*")
