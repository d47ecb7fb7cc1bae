import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from pyspark.sql import functions as F

import llm_rows
from barlab.llm import pu_quality, queries
from barlab.llm.textvec import chunks


def one(text):
    return np.concatenate([pu_quality.features(c) for c in chunks(pa.array([text, "next text"]))])[0]


def test_features_of_a_text():
    got = one("The CAT, the the dog!\nlink | link\nlink | link\n")
    words = ["The", "CAT,", "the", "the", "dog!", "link", "|", "link", "link", "|", "link"]
    n = len(words)
    want = {0: np.log1p(n), 1: sum(map(len, words)) / n, 2: 2 / n, 3: 1 / n, 5: 1 / n, 7: 2 / n, 9: 2 / n, 10: 2 / n, 11: 5 / n, 13: 1 / 3}
    for k, v in want.items():
        assert got[k] == pytest.approx(v), k
    assert got[6] == pytest.approx(4 / 31)


def test_features_without_words():
    for text in ("", None, "  \n "):
        got = one(text)
        assert np.isfinite(got).all() and got[0] == 0


def mixture(n, prior, seed=3):
    rng = np.random.default_rng(seed)
    good = rng.random(n) < prior
    x = rng.normal(size=(n, pu_quality.N_FEATURES))
    x[~good, :3] += 3
    return x, good


def test_scorer_learns_without_negatives():
    x, good = mixture(6000, 0.7)
    p, _ = mixture(2000, 1.0, 4)
    scorer = pu_quality.fit(p, x, 0.7, pu_quality.bin_edges(x))
    test, truth = mixture(4000, 0.7, 5)
    assert ((scorer.score(test) >= 0.5) == truth).mean() > 0.97


def test_prior_is_read_from_all_rows(spark):
    x, good = mixture(6000, 0.7)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, features array<float>")
    ids = [i for i in np.flatnonzero(good)[::2].tolist()]
    _, prior = pu_quality.train(rows, spark.createDataFrame([(i,) for i in ids], "doc_id long"))
    assert abs(prior - 0.7) < 0.06


def test_held_out_documents(spark):
    got = queries.op12_quality_classifier(spark, SF001).join(queries.table(spark, SF001, "labels"), "doc_id").where("held_out")
    share = {r.quality: r.yes for r in got.groupBy("quality").agg(F.avg("predicted").alias("yes")).collect()}
    assert share[1] >= 0.97 and share[0] <= 0.2


def test_awkward_rows(spark):
    docs = llm_rows.docs(spark)
    good = spark.createDataFrame([(5,), (13,), (14,), (15,), (16,), (17,), (5,), (None,), (999,)], "doc_id long")
    rows = pu_quality.classify(docs, good)
    assert set(rows.columns) == (set(docs.columns) - {"text", "features"}) | {"score"}
    got = rows.collect()
    assert len(got) == len(llm_rows.awkward()) and all(0 <= r.score <= 1 for r in got)
    same = {r.score for r in got if r.doc_id in (1, 2)}
    assert len(same) == 1
    # Without a positive nothing is learned; an empty table gives an empty result.
    assert {r.score for r in pu_quality.classify(docs, good.where("false")).collect()} == {0.0}
    assert pu_quality.classify(llm_rows.empty(spark), good).collect() == []
