"""Secrets, licenses, toxicity, decontamination, surrogates: edge cases and plain models."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirework.llm import decontaminate, licenses, secrets, surrogates, toxicity
from quirework.llm.session import fresh_path

#: Names that operators use inside, as extra columns.
CLASH = ["blob", "spans", "row", "fp", "_text", "_key", "_id", "toxic", "severity", "part", "kind", "h", "n"]


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    d = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    return d.withColumns({c: F.lit(i) for i, c in enumerate(CLASH)})


def base(t):
    """Base spans by the wording of the contract."""
    t = t or ""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(out)


SECRETS = [None, "", "clean text", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end', "Password: hunter22 and apiKey=abc", "AKIA" + "A" * 16 + " x", "é secret:abcdef", "x" * 200_000 + " api_key: ZZZZZZ", "a" * 30, "ghp_" + "b" * 36]


def test_secret_scan_by_model(spark, tmp_path):
    d = docs(spark, [*SECRETS, SECRETS[3]], [*range(len(SECRETS)), None])
    rows = secrets.scan_versions(d, str(tmp_path / "ledger")).collect()
    assert len(rows) == len(SECRETS) + 1
    for r in rows:
        t = SECRETS[3 if r.doc_id is None else r.doc_id]
        want = base(t)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in want) for k in range(3))
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    secrets.scan_versions(docs(spark, ["a token: 123456", "b", "b"]), ledger).collect()
    assert spark.read.parquet(ledger).count() == 2
    got = {r.doc_id: r.n_assign for r in secrets.scan_versions(docs(spark, ["b", "c secret=999999", "a token: 123456"]), ledger).collect()}
    assert spark.read.parquet(ledger).count() == 3 and got == {0: 0, 1: 1, 2: 1}
    secrets.scan_versions(docs(spark, ["b"]), ledger, rules="2").collect()
    assert spark.read.parquet(ledger).where("rules = '2'").count() == 1


def test_masking_keeps_all_else(spark):
    d = docs(spark, SECRETS)
    got = secrets.mask_secrets(d, fresh_path(spark, "ledger"))
    assert got.columns == d.columns and got.schema == d.schema
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[0].text is None and rows[2].text == "clean text" and rows[3].text == '[assign]" end' and rows[7].text.endswith(" [assign]") and rows[2].blob == 0


def test_secrets_of_nothing(spark, tmp_path):
    d = docs(spark, ["x"]).limit(0)
    assert secrets.scan_versions(d, str(tmp_path / "l")).count() == 0
    assert secrets.mask_secrets(d, str(tmp_path / "m")).count() == 0


LICENSES = [None, "", "All Rights Reserved. all rights\nreserved", "Released under the MIT License today", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
            "Permission is hereby granted, free of EXTRA charge, to any person obtaining a copy of this software and associated documentation files", "word " * 30_000 + "CC-BY GNU General Public License", "under the License, Version"]


def test_license_scan(spark):
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs(spark, LICENSES)).collect()}
    assert (rows[0].n_words, rows[0].labels, rows[0].score, rows[0].first_word) == (0, "", 0.0, None)
    assert (rows[2].n_base, rows[2].first_word, rows[2].last_word, rows[2].base_labels, rows[2].score) == (2, 0, 3, "reserved", 1.0)
    assert rows[3].labels == "mit" and rows[3].base_labels == "" and rows[3].score == 1.0
    assert rows[4].labels == "mit" and rows[5].labels == "mit" and 0.8 <= rows[5].score < 1
    assert rows[6].n_words == 30_006 and rows[6].base_labels == "cc-by,gpl" and rows[6].first_word == 30_000
    assert rows[7].labels == ""


def test_license_scan_of_repeats_and_nothing(spark):
    d = docs(spark, ["all rights reserved"] * 3 + [None], [1, 1, None, None])
    got = licenses.scan_licenses(d).collect()
    assert len(got) == 4 and sum(r.n_base for r in got) == 3
    again = [r for r in licenses.scan_licenses(d.union(d).repartition(5)).collect()]
    assert len(again) == 8 and sum(r.n_base for r in again) == 6 and sorted((str(r.doc_id), r.labels) for r in again) == sorted((str(r.doc_id), r.labels) for r in got + got)
    assert licenses.scan_licenses(d.limit(0)).count() == 0


def labelled(spark, n=120):
    rng = np.random.default_rng(1)
    plain = ["river", "stone", "meadow", "cloud", "garden", "window", "letter", "market"]
    texts, toxic = [], []
    for i in range(n):
        words = list(rng.choice(plain, 30))
        if i % 3 == 0:
            words += list(rng.choice(["vilemuck", "rotscum", "hatebile"], 1 + i % 4))
        rng.shuffle(words)
        texts.append(" ".join(words))
        toxic.append(int(i % 3 == 0))
    return docs(spark, texts), spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int"), texts, toxic


def test_toxicity_grades_held_out_rows(spark):
    d, labels, texts, toxic = labelled(spark)
    grader = toxicity.train(d, labels.where("doc_id < 80"))
    rows = {r.doc_id: r for r in toxicity.grade(d, grader).collect()}
    assert all(rows[i].toxic == bool(toxic[i]) for i in range(80, 120))
    assert (np.diff(grader.cuts) > 0).all() and all(0 <= r.severity <= 3 for r in rows.values())
    several = np.mean([rows[i].severity for i in range(120) if i % 12 == 3])
    assert several >= np.mean([rows[i].severity for i in range(120) if i % 12 == 0])
    kept = toxicity.keep_clean(d, grader)
    assert kept.schema == d.schema and sorted(r.doc_id for r in kept.collect()) == [i for i in range(120) if not toxic[i]]


def test_toxicity_gradients():
    rng = np.random.default_rng(5)
    x, grade, share = rng.random((40, 7)), rng.integers(0, 4, 40), rng.random(40) / 40
    w, free = rng.standard_normal(7), np.array([0.4, -0.3, 0.2])
    _, g_w, g_free = toxicity.objective(x, grade, share, w, free, 0.01)
    at = lambda w, free: toxicity.objective(x, grade, share, w, free, 0.01)[0]
    for k in range(7):
        e = np.eye(7)[k] * 1e-6
        assert g_w[k] == pytest.approx((at(w + e, free) - at(w - e, free)) / 2e-6, rel=1e-4, abs=1e-8)
    for k in range(3):
        e = np.eye(3)[k] * 1e-6
        assert g_free[k] == pytest.approx((at(w, free + e) - at(w, free - e)) / 2e-6, rel=1e-4, abs=1e-8)


def test_toxicity_by_a_dense_model(spark):
    """Scores by plain counting of words and beginnings, with the fitted weights."""
    d, labels, texts, toxic = labelled(spark)
    grader = toxicity.train(d, labels)
    name = lambda b: toxicity.SpanHasher(np.frombuffer(b, np.uint8))(np.array([0]), np.array([len(b)]))[0]
    place = {int(f): i for i, f in enumerate(grader.features)}
    rows = {r.doc_id: r for r in toxicity.grade(d, grader).collect()}
    for i, text in enumerate(texts):
        words, counts = text.encode().split(), {}
        for word in words:
            for f in [int(name(word) ^ toxicity._WHOLE), *[int(name(word[:n])) for n in toxicity.PREFIXES if len(word) > n]]:
                counts[f] = counts.get(f, 0) + 1
        score = sum(grader.weights[place[f]] * min(1, toxicity.FULL_SHARE * n / max(len(words), toxicity.LEAST_WORDS)) for f, n in counts.items() if f in place)
        q = 1 / (1 + np.exp(-(score - grader.cuts)))
        assert rows[i].severity == pytest.approx(q.sum(), abs=1e-5) and rows[i].p_toxic == pytest.approx(q[0], abs=1e-5)


def test_toxicity_of_repeated_rows(spark):
    d, labels, texts, _ = labelled(spark)
    twice = d.union(d)
    got = toxicity.grade(twice, toxicity.train(twice, labels.union(labels))).collect()
    assert len(got) == 2 * len(texts) and len({(r.doc_id, r.severity) for r in got}) == len(texts)


def test_toxicity_without_a_model(spark):
    d = docs(spark, [None, "", "text"], [1, None, 3])
    grader = toxicity.train(d, spark.createDataFrame([(3, 1, 1), (None, 0, 1), (9, 1, None)], "doc_id long, quality int, toxic int"))
    assert [(r.severity, r.toxic) for r in toxicity.grade(d, grader).collect()] == [(0.0, False)] * 3
    assert toxicity.keep_clean(d, grader).count() == 3


WORDS = "amber basin cedar delta ember fjord glade heron inlet juniper karst lagoon marsh nectar opal prairie quartz ridge spruce tundra".split()


def item(i, n=24):
    rng = np.random.default_rng(i + 100)
    w = [f"{a}{b}" for a, b in zip(rng.choice(WORDS, n), rng.integers(0, 50, n))]
    return " ".join(w[: n - 8]).capitalize() + ". " + " ".join(w[n - 8 :]).capitalize() + "."


def overlap(text, it):
    """Question and answer shingles of an item found anywhere in a text, and whether all of it stands in one place."""
    return " ".join(decontaminate.words_of(it)) in " ".join(decontaminate.words_of(text))


def test_leaks_by_model(spark):
    items = [item(i) for i in range(40)]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(90, None), (91, ""), (3, items[3])], "item_id long, text string")
    filler = lambda k, n: " ".join(f"filler{(k * 31 + j) % 997}" for j in range(n))
    texts = [filler(1, 300), filler(2, 70) + " " + items[5] + " " + filler(3, 90), items[7].upper(), None, "", items[9].split(". ")[0], filler(4, 20_000) + " " + items[11] + " " + items[12], filler(5, 31) + " " + items[13]]
    d = docs(spark, [*texts, texts[1]], [*range(len(texts)), 1])
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(d, benchmark).collect())
    want = sorted((i, j) for i, t in enumerate(texts) for j, it in enumerate(items) if t and overlap(t, it))
    assert got == want and (6, 11) in got and (6, 12) in got and (5, 9) not in got
    kept = decontaminate.drop_leaks(d, benchmark)
    assert kept.schema == d.schema and sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 5]
    # The same with several indexes.
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(d, benchmark, index_units=16).collect()) == want


def test_leaks_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    d = docs(spark, ["a b c", None])
    assert decontaminate.find_leaks(d, none).count() == 0 and decontaminate.drop_leaks(d, none).count() == 2
    some = spark.createDataFrame([(1, item(1))], "item_id long, text string")
    assert decontaminate.find_leaks(d.limit(0), some).count() == 0


@pytest.mark.parametrize("units,vocabulary,length,ranges", [(70, 60, 12, 64), (900, 400, 12, 3), (2000, 3000, 30, 64), (1, 5, 3, 64), (333, 2000, 20, 1)])
def test_block_max_search_equals_full_scores(monkeypatch, units, vocabulary, length, ranges):
    monkeypatch.setattr(decontaminate, "RANGES", ranges)
    rng = np.random.default_rng(units)
    held = [np.unique((vocabulary * rng.random(length) ** 2).astype(int)) for _ in range(units)]
    unit = np.concatenate([[u] * len(t) for u, t in enumerate(held)])
    term = np.concatenate(held).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    impact = np.concatenate([x / x.sum() for t in held for x in [rng.random(len(t)) + 0.1]])
    index = decontaminate.Index(unit, term, impact, np.arange(units), [(i, [], []) for i in range(units)])
    passages = [np.unique(np.concatenate([(vocabulary * rng.random(2 * length) ** 2).astype(int), held[i % units][: length // (1 + i % 3)]])) for i in range(150)]
    p = np.concatenate([[i] * len(t) for i, t in enumerate(passages)])
    tid = index.term_ids(np.concatenate(passages).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ok = tid >= 0
    got = {(a, b): s for a, b, s in zip(*index.search(p[ok], tid[ok], 0.5))}
    weight = np.zeros((units, vocabulary))
    weight[unit, np.concatenate(held)] = impact
    full = np.stack([weight[:, t].sum(axis=1) for t in passages])
    want = {(i, u): full[i, u] for i, u in zip(*np.nonzero(full >= 0.5 - 1e-9))}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    all_postings = int(sum((weight[:, t] > 0).sum() for t in passages))
    if units >= 900:  # skipping spares most postings
        assert index.scored < all_postings / 2, (index.scored, all_postings)


def test_long_items_are_cut(spark):
    words = [f"{a}{i % 977}" for i, a in enumerate(np.random.default_rng(2).choice(WORDS, 3000))]
    benchmark = spark.createDataFrame([(1, " ".join(words)), (2, item(2))], "item_id long, text string")
    d = docs(spark, [" ".join(words), "x " * 50 + " ".join(words[1000:2600]), "other words " * 200, item(2)])
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(d, benchmark, index_units=40).collect())
    assert got == [(0, 1), (1, 1), (3, 2)]
    assert all(len(i.owner) <= 40 for i in decontaminate.build_indexes(benchmark, 40))
    # Held together, the larger part of an item is not the item.
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(d, benchmark).collect()) == [(0, 1), (3, 2)]


PII = ["Mr. John Smith wrote to mary.jones7@mail3.example.com, later Mr Smith called +1 (743) 555-3824.", "Call (743) 555-3824 or JOHN SMITH at 192.168.4.20", "card 4757965300669737, not 9870157079875996, nor version 1.2.3", None, "", "clean words only",
       "Госпожа Анна Иванова и Κυρία Ελένη Παππά, IBAN GB82 WEST 1234 5698 7654 32", "z " * 60_000 + "last@mail9.example.com"]


def test_surrogates(spark):
    d = docs(spark, [*PII, PII[0]], [*range(len(PII)), None])
    rows = {r.doc_id: r for r in surrogates.replace_entities(d, b"key").collect()}
    assert len(rows) == len(PII) + 1 and rows[None].text == rows[0].text
    for i in (3, 4, 5):
        assert rows[i].text == PII[i] and rows[i].n_entities == 0
    for secret in ("John", "Smith", "mary", "555-3824", "192.168.4.20", "4757965300669737", "Иванов", "Ελένη", "last@"):
        assert not any(secret in (r.text or "") for r in rows.values()), secret
    assert "9870157079875996" in rows[2].text and "version 1.2.3" in rows[2].text
    # One person, one number: the same surrogate in both ways of writing.
    name = re.match(r"Mr\. (\w+) (\w+) wrote", rows[0].text)
    assert f"Mr {name[2]} called" in rows[0].text and f"{name[1]} {name[2]}".upper() in rows[1].text
    phone = re.search(r"\+1 (\(\d{3}\) \d{3}-\d{4})\.", rows[0].text)[1]
    assert phone in rows[1].text
    card = re.search(r"card (\d{16}),", rows[2].text)[1]
    assert surrogates._luhn(card) and card[0] == "4"
    assert re.search(r"Госпожа [А-Я][а-я]+ [А-Я][а-я]+а и", rows[6].text)
    assert len(rows[7].text) == len(PII[7])


def test_surrogates_are_distinct_even_in_a_narrow_format(spark):
    texts = [f"{c}{n}@m.example.com" for c in "abcdefghij" for n in range(10)]
    d = docs(spark, texts)
    got = [r.text for r in surrogates.replace_entities(d, b"key").collect()]
    assert len(set(got)) == len(texts) and not set(got) & set(texts)
    joined = {r.doc_id: r.text for r in surrogates.replace_entities(d, b"key", max_broadcast=0).collect()}
    assert joined == {r.doc_id: r.text for r in surrogates.replace_entities(d, b"key").collect()}
    other = [r.text for r in surrogates.replace_entities(d, b"other").collect()]
    assert other != got
    assert surrogates.replace_entities(d.limit(0), b"key").count() == 0
