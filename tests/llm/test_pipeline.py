"""The pipeline over a small corpus of its own, stage by stage and as a whole."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline

RIVER = "river stone meadow cloud garden window letter market valley bridge autumn lantern harbor copper willow saddle".split()


def corpus(tmp_path, spark):
    rng = np.random.default_rng(7)
    text = lambda n: " ".join(rng.choice(RIVER, n)) + f" note{rng.integers(1 << 30)}"
    texts = [text(60) for _ in range(90)]
    for i in range(0, 90, 3):
        texts[i] += " vilemuck rotscum hatebile"
    items = [" ".join(f"{a}{b}" for a, b in zip(rng.choice(RIVER, 24), rng.integers(0, 99, 24))) for _ in range(5)]
    texts += [texts[1], texts[1], text(40) + " " + items[2] + " " + text(30), 'clean start token = "abcdef123456" clean end', None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return texts


def test_stages(spark, tmp_path):
    texts = corpus(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    schema, kept = docs.schema, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/stage-{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage-{k}")
        assert docs.columns == schema.names
        kept.append({r.doc_id: r.text for r in docs.collect()})
    clean = [i for i in range(len(texts)) if not (i < 90 and i % 3 == 0)]
    assert sorted(kept[0]) == clean
    assert sorted(kept[1]) == [i for i in clean if i not in (90, 91, 95)]  # copies, and the empty text beside the null one
    assert sorted(kept[2]) == [i for i in sorted(kept[1]) if i != 92]
    assert kept[3][93] == 'clean start [assign]" clean end' and all(kept[3][i] == t for i, t in kept[2].items() if i != 93)
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(out) == sorted(kept[3])
    assert all(r.decoded_sha256 == hashlib.sha256((kept[3][i] or "").encode()).hexdigest() and len(r.ids) == r.n_tokens for i, r in out.items())


def test_empty_corpus(spark, tmp_path):
    corpus(tmp_path, spark)
    none = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name
