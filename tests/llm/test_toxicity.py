import numpy as np
from pyspark.sql import functions as F

from barlab.llm import toxicity
from barlab.llm.queries import op3_toxicity, table
from llm_rows import awkward, docs, empty, prose
import random

SF01 = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    label = {r.doc_id: r.toxic for r in table(spark, SF01, "labels").collect()}
    rows = op3_toxicity(spark, SF01).collect()
    assert len(rows) == table(spark, SF01, "documents").count()
    held = [(r.score, label[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in label]
    score, y, predicted = (np.array(x) for x in zip(*held))
    rank = score.argsort().argsort()
    n1, n0 = y.sum(), (1 - y).sum()
    assert (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * n0) > 0.95
    assert predicted[y == 1].mean() > 0.7 and predicted[y == 0].mean() < 0.02
    assert all(p == (s >= 0.3) for s, p in zip(score, predicted)) and score.min() >= 0 and score.max() <= 1


def test_updates_match_a_plain_loop():
    import math

    import pandas as pd

    rnd = random.Random(6)
    rows = [(k, int(k % 3 == 0), sorted({rnd.randrange(40) for _ in range(6)} | ({99} if k % 3 == 0 else set()))) for k in range(60)]
    z, n = {}, {}

    def weight(i):
        l1 = 0.0 if i == toxicity._BIAS else toxicity.L1
        v = z.get(i, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for _, y, at in rows:
            at = [*at, toxicity._BIAS]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in at:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    want = {i: weight(i) for i in z if weight(i)}
    frame = pd.DataFrame([(k, y, np.array(at)) for k, y, at in rows], columns=["order", "toxic", "at"])
    got = toxicity._ftrl(frame)
    assert set(got["at"]) == set(want) and 99 in want
    assert all(abs(w - want[i]) < 1e-9 for i, w in zip(got["at"], got["weight"]))


def test_awkward_rows_and_missing_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score(docs(spark), toxicity.train(docs(spark), none)).collect()
    assert len(rows) == len(awkward()) and {r.score for r in rows} == {0.5}
    some = spark.createDataFrame([(5, 1), (5, 0), (9, 0), (None, 1), (10, None), (999, 1)], "doc_id long, toxic int")
    rows = toxicity.score(docs(spark), toxicity.train(docs(spark), some)).collect()
    assert all(0 <= r.score <= 1 for r in rows) and len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.score(empty(spark), toxicity.train(empty(spark), none)).count() == 0


def test_labels_of_other_rows_change_nothing(spark):
    rnd = random.Random(1)
    rows = [(i, prose(rnd, 30) + (" awful" if i % 2 else ""), "en", "s", 1) for i in range(200)]
    df = docs(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(df, toxicity.train(df, labels)).collect()}
    assert min(got[i] for i in range(151, 200, 2)) > max(got[i] for i in range(150, 200, 2))
    other = {r.doc_id: r.score for r in toxicity.score(df.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), toxicity.train(df, labels)).collect()}
    assert other == got


def test_rows_of_one_id_count_towards_the_bound(spark, monkeypatch):
    sizes = spark.sparkContext.accumulator(0)
    plain = toxicity._ftrl

    def counted(rows):
        sizes.add(len(rows))
        return plain(rows)

    monkeypatch.setattr(toxicity, "_ftrl", counted)
    docs = spark.createDataFrame([(i % 3, f"word{i} another{i % 5}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    toxicity.train(docs, labels, sample_docs=50).collect()
    assert sizes.value == 50
