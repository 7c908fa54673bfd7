"""Language identification: held-out accuracy, gradients, and defined results."""

import zlib

import numpy as np

from snapfold.llm import byte_cnn as op, common

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op.op6_byte_cnn(spark, SF).collect()}
    docs = common.table(spark, SF, "documents").collect()
    assert len(rows) == len(docs)
    assert {r.doc_id for r in rows.values() if r.held_out} == {d.doc_id for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 == 2}
    held = [d for d in docs if rows[d.doc_id].held_out and d.lang]
    assert np.mean([rows[d.doc_id].lang_pred == d.lang for d in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_joined_tables_give_equal_responses():
    model = op.ByteCNN(["a", "b", "c"], op.Settings(widths=(2, 3, 4, 5), window=40))
    x = np.random.default_rng(1).integers(0, 256, (7, 40)).astype(np.uint8)
    plain = model.probabilities(x)
    assert np.allclose(model.freeze().probabilities(x), plain, atol=1e-5)


def test_training_lowers_the_loss():
    settings = op.Settings(window=32, epochs=20, batch=16)
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 200)
    x = rng.integers(97, 123, (200, 32)).astype(np.uint8)
    x[np.arange(200), rng.integers(0, 30, 200)] = np.where(y, 35, 36)
    model = op.ByteCNN(["n", "y"], settings).train(x, y)
    assert (model.probabilities(x).argmax(axis=1) == y).mean() > 0.95


def test_edges_of_input(spark):
    words = {"aa": "the quick brown fox jumps over it ", "bb": "der schnelle fuchs springt über ihn "}
    rows = [(i, words[lang] * 9, lang, "x", 0.5) for i in range(60) for lang in ("aa", "bb")]
    rows += [(90, None, "aa", None, None), (91, "", "bb", None, None), (92, "12 +- !?", "aa", None, None),
             (93, words["bb"] * 9, None, None, None), (None, words["aa"] * 3000, "aa", None, None), (94, "日本", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    model = op.fit(df)
    assert model.labels == ["aa", "bb"]
    got = df.where("doc_id >= 90 or doc_id is null").select("doc_id", op.language(df["text"], model, spark).alias("p")).collect()
    found = {r.doc_id: r.p for r in got}
    assert {i: found[i].lang_pred for i in (90, 91, 92, 93, None)} == {90: "und", 91: "und", 92: "und", 93: "bb", None: "aa"}
    assert found[90].score == 0 and found[94].lang_pred in ("aa", "bb")
    nothing = op.fit(df.limit(0))
    assert df.limit(3).select(op.language(df["text"], nothing, spark)["lang_pred"].alias("l")).collect()[0].l == "und"
