"""Toxicity grades: held-out accuracy, order of the thresholds, and defined results."""

import numpy as np

from snapfold.llm import common, toxicity_ordinal as op

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    model = op.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = docs.join(labels.where("doc_id % 2 = 1"), "doc_id").select("doc_id", "toxic", op.severity(docs["text"], model, spark).alias("s")).collect()
    told = np.array([r.s.toxic for r in rows])
    toxic = np.array([r.toxic == 1 for r in rows])
    assert told[toxic].mean() > 0.9 and told[~toxic].mean() < 0.03  # of some 200 toxic texts learned from
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 3
    assert all(0 <= r.s.expected_severity <= 3 and r.s.toxic == (r.s.p_toxic >= 0.5) for r in rows)


def test_shared_weights_order_the_grades():
    rng = np.random.default_rng(2)
    hits = rng.integers(0, 10, 900)
    row = np.repeat(np.arange(900), hits)
    column = np.concatenate([rng.permutation(10)[:h] for h in hits]).astype(int)
    grade = np.digitize(hits, [3, 6, 8])
    weights, cut = op._proximal(row, column, 10, grade, op.Settings(penalty=0.0, rounds=800))
    z = np.bincount(row, weights=weights[column], minlength=900)
    got = (z[:, None] > cut[None, :]).sum(axis=1)
    assert (got == grade).mean() > 0.9 and (weights > 0).all()


def test_edges_of_input(spark):
    bad, good = "you are an idiot and a moron ", "what a nice day it is today "
    rows = [(i, (bad if i % 2 else good) + f"w{i}", i, True) for i in range(40)]
    rows += [(50, None, 0, None), (51, "", 0, None), (52, "12 34", 0, None), (None, bad * 5000, 0, None), (1, rows[1][1], 0, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, grade int, toxic boolean")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (None, 1), (3, None)], "doc_id long, toxic long")
    model = op.fit(df, labels)
    got = df.select("doc_id", op.severity(df["text"], model, spark).alias("s")).collect()
    assert len(got) == len(rows)
    assert all(r.s.expected_severity == 0 and not r.s.toxic for r in got if r.doc_id in (50, 51, 52))
    assert all(r.s.toxic == (r.doc_id is None or r.doc_id % 2 == 1) for r in got if r.doc_id not in (50, 51, 52))
    for none in (labels.limit(0), labels.where("toxic = 0")):
        assert not any(r.t for r in df.select(op.severity(df["text"], op.fit(df, none), spark)["toxic"].alias("t")).collect())
