"""Secret scans over an incremental ledger of blobs.

Every historical version's text is a blob named by its SHA-256 (null counts as empty). The
ledger has a folder for each rule version with one row for each blob scanned so far, and what
was found; only pairs it lacks are scanned, one copy of each, and findings are joined back to
all rows that hold the blob. Spans are code points, end exclusive, as ``kind:start:end`` by
start, then kind.

Base kinds: assign, access, hex. Further kinds: pem (a private key from its BEGIN line to its END
line, or without one over the base64 that follows), github and slack tokens, jwt, urlpass
(password within a url). Rows may repeat and ids be null: each row gets its blob's findings.
Columns beyond those named play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.session import fresh_path, materialize, spread_join, table, told_apart
from quirework.llm.textvec import text_slices

RULES_VERSION = "1"
KINDS = ("assign", "access", "hex", "pem", "github", "slack", "jwt", "urlpass")
_either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
_KEYS = "|".join(_either(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either("api") + "_?" + _either("key")
_ASSIGN = re.compile(rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is taken from its start, a shorter one fails
#: A private key: up to its END line (a single hyphen may stand within), else header fields and runs of base64. Line feeds may be written as \\n.
_PEM = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[^-]*(?:-[^-]+)*-----END [A-Z ]{0,40}PRIVATE KEY-----|(?:(?:[\s>\"'+]|\\[rn]|(?:Proc-Type|DEK-Info|Comment): ?[^\n\\]*)*[A-Za-z0-9+/]{16,}={0,2})*(?:(?:[\s>\"'+]|\\[rn])*[A-Za-z0-9+/]{1,15}={1,2})?)"
_MORE = (
    ("pem", "-----BEGIN", re.compile(_PEM)),
    ("github", "gh", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", "xox", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    ("jwt", "eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("urlpass", "://", re.compile(r"://[^\s:/@]{1,64}:[^\s:/@]{1,128}@")),
)
#: The short last line of a key without END line, which masking takes as well.
_PEM_TAIL = re.compile(r"(?:\s|\\[rn])*+(?<=[\sn])[A-Za-z0-9+/]{2,15}+(?=\s*+(?:\n|\Z))")
_HINTS = ("password", "passwd", "secret", "token", "api_key", "apikey")


def find_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, number of the kind in KINDS, end) of all spans, in order."""
    t = text or ""
    out = [(m.start(), 2, m.end()) for m in _HEX.finditer(t)]
    if "AKIA" in t:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(t) if m.end() - m.start() >= 20]
    if ":" in t or "=" in t:
        low = t.lower()
        if any(h in low for h in _HINTS):
            out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(t) if m.end(2) - m.start(2) >= 6]
    for kind, hint, rule in _MORE:
        if hint in t:
            out += [(m.start(), KINDS.index(kind), m.end()) for m in rule.finditer(t)]
    return sorted(out)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


_NOTHING = hashlib.sha256(b"").hexdigest()
_LEDGER = "blob string, rules string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _scan(df: DataFrame, ledger: str, rules: str, text_col: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows' ids with their blobs, and the ledger's rows with spans of those blobs with n, how many rows hold them; both stored."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    versions = df.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("blob"), text.alias("text"))
    paths = materialize(versions.select("id", "blob"), "blob-paths")
    counted = paths.groupBy("blob").agg(F.count("*").alias("n"))
    apart = counted.where("n > 1").select("blob")
    done = spark.read.schema(_LEDGER).parquet(ledger).where(F.col("rules") == rules).select("blob") if _exists(spark, ledger) else None
    if done is not None:
        apart = apart.union(counted.select("blob").join(done, "blob", "left_semi"))
    # New texts without a copy are scanned where they lie. Copies are merged before the shuffle, so a text that a third of all rows hold goes out once from each task.
    dealt, alone = told_apart(versions.select("blob", "text"), apart, "blob")
    once = dealt.groupBy("blob").agg(F.first("text").alias("text"))
    if done is not None:
        once = once.join(done, "blob", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text"):
                rows = []
                for blob, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    found = find_spans(t)
                    base = [s for s in found if s[1] < 3]
                    counts = [sum(s[1] == k for s in base) for k in range(3)]
                    rows.append((blob, rules, *counts, hashlib.sha256(written(base).encode()).hexdigest() if base else _NOTHING, written(found)))
                names = ["blob", "rules", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    alone.union(once.select("blob", "text")).mapInArrow(run, _LEDGER).write.mode("append").partitionBy("rules").parquet(ledger)
    told = spark.read.schema(_LEDGER).parquet(ledger).where((F.col("rules") == rules) & (F.col("spans") != "")).drop("rules").dropDuplicates(["blob"])
    held = paths.select("blob").join(told.select("blob"), "blob", "left_semi").groupBy("blob").agg(F.count("*").alias("n"))
    return paths, materialize(told.join(held, "blob"), "findings")


def scan_versions(df: DataFrame, ledger: str, rules: str = RULES_VERSION, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Scan what ``ledger`` (a folder, made if missing) lacks, add to it, and give every row its findings.

    Columns ``id_col``, blob, n_assign, n_access, n_hex, base_sha256, spans, one row for each
    row of ``df``. A run that ends early leaves the ledger without the blobs it was scanning.
    """
    joined = spread_join(*_scan(df, ledger, rules, text_col, id_col), ["blob"], how="left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return joined.select(F.col("id").alias(id_col), "blob", zero("n_assign"), zero("n_access"), zero("n_hex"), F.coalesce("base_sha256", F.lit(_NOTHING)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def mask_secrets(df: DataFrame, ledger: str, rules: str = RULES_VERSION, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``df`` scanned by way of ``ledger``, every span of ``text_col`` replaced by ``[kind]``; overlapping spans go together under the first one's kind.

    All columns stay, whatever their names; null texts stay null. ``df`` must be a stored table.
    Rows without spans stay where they are; only those that hold some are dealt to their spans.
    """
    found = _scan(df, ledger, rules, text_col, id_col)[1].select("blob", "spans", "n")
    packed = df.select(F.struct(*df.columns).alias("row"), F.col(text_col).alias("text"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob"))
    held, clean = told_apart(packed, found, "blob")
    joined = spread_join(held, found, ["blob"], how="left").select("row", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text"):
                texts = b.column(1)
                if b.column(2).null_count < b.num_rows:
                    texts = pa.array([t if s is None else masked(t, s) for t, s in zip(texts.to_pylist(), b.column(2).to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0), texts], ["row", "text"])

    done = clean.select("row", "text").union(joined.mapInArrow(run, joined.select("row", "text").schema))
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in df.columns])


def masked(text: str, spans: str) -> str:
    """``spans`` as ``written`` makes them."""
    out, at, upto = [], 0, 0
    for kind, a, z in (s.split(":") for s in spans.split(",")):
        a, z = int(a), int(z)
        if kind == "pem" and not text.endswith("PRIVATE KEY-----", a, z) and (tail := _PEM_TAIL.match(text, z)):
            z = tail.end()
        if a >= upto:
            out += [text[at:a], f"[{kind}]"]
        at = upto = max(z, upto)
    return "".join([*out, text[at:]])


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_versions(table(spark, sf_dir, "documents"), fresh_path(spark, "secret-ledger"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def _oracle() -> str:
    """Positions from the lengths of what stands between the matches of each kind."""
    least = {"assign": ("regexp_extract_all(t, '{p}', 2)", 6), "access": ("regexp_extract_all(t, '{p}')", 20)}
    rules = [("assign", _ASSIGN), ("access", _ACCESS), ("hex", _HEX), *((k, r) for k, _, r in _MORE)]
    parts = []
    for kind, rule in rules:
        pattern = rule.pattern.replace("'", "''")
        told, size = least.get(kind, ("regexp_extract_all(t, '{p}')", 1))
        parts.append(f"SELECT doc_id, {KINDS.index(kind)} AS k, '{kind}' AS kind, regexp_extract_all(t, '{pattern}') AS m, {told.replace('{p}', pattern)} AS g, regexp_split_to_array(t, '{pattern}') AS p, {size} AS least FROM d WHERE regexp_matches(t, '{pattern}')")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS ({" UNION ALL ".join(parts)}),
b AS (SELECT *, unnest(generate_series(1, len(m))) AS i FROM a),
c AS (SELECT doc_id, k, kind, CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s, length(m[i]) AS n FROM b WHERE length(g[i]) >= least),
e AS (SELECT doc_id, count(CASE WHEN k = 0 THEN 1 END) AS n_assign, count(CASE WHEN k = 1 THEN 1 END) AS n_access, count(CASE WHEN k = 2 THEN 1 END) AS n_hex,
  coalesce(string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, k, n) FILTER (k < 3), '') AS base, string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, k, n) AS spans FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN e ON e.doc_id = d.doc_id
"""


ORACLE_OP5 = _oracle()
