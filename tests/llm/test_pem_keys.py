"""Masking of PEM private keys."""

import base64
import random

from quirework.llm import secrets
from quirework.llm.session import fresh_path

BODY = base64.b64encode(random.Random(1).randbytes(610)).decode()
LINES = [BODY[i : i + 64] for i in range(0, len(BODY), 64)]


def block(kind="RSA ", feed="\n", end=True, fields=""):
    return feed.join([f"-----BEGIN {kind}PRIVATE KEY-----", *([fields, ""] if fields else []), *LINES, *([f"-----END {kind}PRIVATE KEY-----"] if end else [])])


def test_no_key_stays(spark):
    keys = [block(), block(""), block("EC ", "\r\n"), block(feed=" "), block(feed="\\n"), block(fields="Proc-Type: 4,ENCRYPTED"), block(end=False), block("", "\\n", False), block(feed="\r\n", end=False, fields="DEK-Info: AES-128-CBC,00")]
    texts = [f"before it\n{k}\nafter it here" for k in keys]
    texts += [f"one {block(end=False)}\n\nplain words stay\n{block('')} two", "only -----BEGIN PRIVATE KEY----- in prose, no key"]
    texts.append("-----BEGIN PRIVATE KEY-----" * 40_000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in secrets.mask_secrets(docs, fresh_path(spark, "ledger")).collect()}
    for i in range(len(keys)):
        assert got[i].startswith("before it\n[pem]") and got[i].endswith("\nafter it here") and len(got[i]) < 32, (i, got[i])
    assert got[9] == "one [pem]\n\nplain words stay\n[pem] two"
    assert got[10] == "only [pem] in prose, no key" and "BEGIN" not in got[11]


def test_spans_hold_the_key():
    text = f"x {block()} y {block('', end=False)}\n\nz"
    spans = [s for s in secrets.find_spans(text) if s[1] == secrets.KINDS.index("pem")]
    assert [text[a:z] for a, _, z in spans] == [block(), block("", end=False)]


def test_hot_blobs_and_null_ids(spark):
    texts = ['the key "token = abcdef123456" of many'] * 300 + ["clean"] * 300 + [f"own {i} secret: zzzzzz{i}" for i in range(100)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(7)
    path = fresh_path(spark, "hot")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    got = secrets.scan_versions(docs, fresh_path(spark, "ledger")).collect()
    assert len(got) == 700 and sum(r.n_assign for r in got) == 400
    masked = [r.text for r in secrets.mask_secrets(docs, fresh_path(spark, "ledger")).collect()]
    assert sorted(masked) == sorted(['the key "[assign]" of many'] * 300 + ["clean"] * 300 + [f"own {i} [assign]" for i in range(100)])
