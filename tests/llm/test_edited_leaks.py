"""Benchmark items with changed words."""

import numpy as np

from quirework.llm import decontaminate


def test_edited_items_are_found(spark):
    rng = np.random.default_rng(5)
    items, texts, want = [], [], set()
    filler = lambda k, n: " ".join(f"filler{(k * 31 + j) % 997}" for j in range(n))
    for i in range(12):
        w = [f"{a}{b}" for a, b in zip(rng.choice(["amber", "basin", "cedar", "delta", "ember"], 40), rng.integers(0, 99, 40))]
        cut = 40 - 6 if i % 2 else 40  # a short last sentence, or one sentence
        sentence = lambda w: " ".join(w[:cut]) + ("." if cut == 40 else ". " + " ".join(w[cut:]) + ".")
        items.append(sentence(w))
        for at in (2, 20, 33, 37, 39):
            other = list(w)
            other[at] = "changed"
            want.add((len(texts), i))
            texts.append(filler(len(texts), 37) + " " + sentence(other) + " " + filler(len(texts) + 5, 60))
        texts.append(" ".join(w[:24]) + " " + filler(i, 90))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, benchmark).collect()} == want
    assert {r.doc_id for r in decontaminate.drop_leaks(docs, benchmark).collect()} == set(range(len(texts))) - {d for d, _ in want}
    # Real answers are tested for themselves.
    parted = spark.createDataFrame([(i, *map(" ".join, decontaminate.question_and_answer(t))) for i, t in enumerate(items)], "item_id long, text string, answer string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, parted, answer_col="answer").collect()} < want
