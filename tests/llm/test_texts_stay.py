"""Texts are not shuffled where digests, hashes or row numbers do."""

import time

import numpy as np
import pytest

import corpus_pipeline
from quirework.llm import secrets, session
from quirework.llm.session import fresh_path


def shuffled(spark):
    """Bytes that tasks have written for shuffles so far."""
    time.sleep(0.5)
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()


def stored(spark, texts):
    path = fresh_path(spark, "texts")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(path)
    return spark.read.parquet(path), sum(len(t or "") for t in texts)


def noise(rng, n=20_000):
    return " ".join(map(str, rng.integers(0, 1 << 60, n // 18)))


def test_masking_deals_only_texts_with_spans(spark):
    rng = np.random.default_rng(3)
    texts = [noise(rng) for _ in range(200)]
    texts[7] += " token = abcdef123456"
    texts += [texts[7], texts[9], None, ""]
    docs, size = stored(spark, texts)
    ledger, before = fresh_path(spark, "ledger"), shuffled(spark)
    got = {r.doc_id: r.text for r in secrets.mask_secrets(docs, ledger).collect()}
    assert shuffled(spark) - before < size / 10
    assert got == {i: t and t.replace("token = abcdef123456", "[assign]") for i, t in enumerate(texts)}
    kept = spark.read.parquet(ledger)
    assert kept.count() == kept.select("blob").distinct().count() == len({t or "" for t in texts})
    more, _ = stored(spark, [*texts[:20], "new secret: zzzzzz9"])
    again = {r.doc_id: r.text for r in secrets.mask_secrets(more, ledger).collect()}
    assert again == {**{i: got[i] for i in range(20)}, 20: "new [assign]"} and spark.read.parquet(ledger).count() == kept.count() + 1


def test_masking_with_too_many_keys_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(session, "FEW", 2)
    texts = [f"own {i} secret: zzzzzz{i}" for i in range(20)] * 2 + ["clean"] * 3 + [None]
    docs, _ = stored(spark, texts)
    got = {r.doc_id: r.text for r in secrets.mask_secrets(docs, fresh_path(spark, "ledger")).collect()}
    assert got == {i: f"own {i % 20} [assign]" if i < 40 else t for i, t in enumerate(texts)}


def test_near_copies_leave_other_texts_in_place(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rng = np.random.default_rng(5)
    texts = [noise(rng) for _ in range(200)]
    texts += [texts[3], texts[9] + " one more word", None, ""]
    docs, size = stored(spark, texts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        before = shuffled(spark)
        kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
        written = shuffled(spark) - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert kept == [*range(200), 202]
    assert written < size / 2


@pytest.mark.parametrize("few", [session.FEW, 0])
def test_numbered_rows(spark, monkeypatch, few):
    monkeypatch.setattr(session, "FEW", few)
    ids = [0, 1, 62, 63, 64, 127, 128, (1 << 33) - 1, 1 << 33, (5 << 33) + 63]
    rows = spark.createDataFrame([(u, str(u)) for i in ids for u in (i, i + 200)], "uid long, t string").distinct()
    got = session.numbered(rows, spark.createDataFrame([(i,) for i in ids], "uid long"))
    assert got.columns == ["uid", "t"] and sorted(r.uid for r in got.collect()) == ids
