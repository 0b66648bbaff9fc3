"""Near copies against brute force over all pairs."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from framewright.llm import near_copies


def plain_groups(texts):
    """Smallest position linked, by Jaccard similarity of sets of 5-word tuples."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(texts))]


def edited_texts():
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    license_line = [word() for _ in range(40)]
    texts = [None, "", " \n", "one", "ONE", "one two", "a b c d e", "a b c d e f"]
    for n in (8, 30, 60, 150, 150, 400):
        base = [word() for _ in range(n)] + license_line * (n == 60)
        texts.append(" ".join(base))
        for edits in range(1, 9):
            edit = list(base)
            for _ in range(edits):
                edit[rng.integers(len(edit))] = word()
            texts.append(" ".join(edit))
        texts += [" ".join(base[: len(base) * k // 20]) for k in (15, 16, 17, 18, 19)] + [" ".join(base).upper()]
    return texts


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("web"))


def test_stage_equals_brute_force(spark):
    texts = edited_texts()
    root = plain_groups(texts)
    assert len(set(root)) < len(texts) - 40
    df = frame(spark, list(enumerate(texts))).repartition(5)
    out = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(root))
    assert near_copies.keep_one(df.limit(0)).count() == 0


def test_frequencies_do_not_change_links(spark, monkeypatch):
    texts = edited_texts()
    df = frame(spark, list(enumerate(texts)))
    monkeypatch.setattr(near_copies, "COMMON", 7)
    monkeypatch.setattr(near_copies, "COUNTED", 500)
    assert sorted(r["doc_id"] for r in near_copies.keep_one(df).collect()) == sorted(set(plain_groups(texts)))


def test_repeated_and_null_ids_are_rows_of_their_own(spark):
    base = [f"w{k}" for k in range(100)]
    edit = lambda *at: " ".join("x" if k in at else w for k, w in enumerate(base))
    rows = [(3, edit()), (3, edit()), (None, edit()), (9, edit()), (None, "lone text"), (5, "other"), (5, "other")]
    rows += [(20, " ".join(base[:80])), (None, " ".join(base[:90])), (21, " ".join(base))]  # 90 words link 80 and 100
    got = near_copies.keep_one(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in got) == [
        (False, 3, edit()), (False, 5, "other"), (True, 0, "lone text")
    ]
