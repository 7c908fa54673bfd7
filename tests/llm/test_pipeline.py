"""The pipeline's stages, each on all that the one before it kept."""

import pytest

import corpus_pipeline as pipeline
from snapfold.llm import common, line_dedup, quality_rules, sentencepiece_fst, simhash_covering, spaced_seeds

from .test_line_dedup import expected as dropped
from .test_quality import judged
from .test_simhash import expected as grouped

SF = "/root/testdata/sf0.001"


def test_every_stage_equals_brute_force(spark, tmp_path):
    docs = common.table(spark, SF, "documents")
    names, columns = [n for n, _ in pipeline.STAGES], docs.columns
    assert len(names) == len(set(names)) == 5
    kept = {r.doc_id: r.text for r in docs.collect()}
    items = [op[1] for op in spaced_seeds_items(spark)]

    def stage(number, now):
        out = pipeline.STAGES[number][1](spark, now, SF)
        out.write.parquet(f"{tmp_path}/{number}")
        return spark.read.parquet(f"{tmp_path}/{number}")

    now = stage(0, docs)
    assert now.columns == columns
    kept = {i: t for i, t in kept.items() if judged(t)[-1]}
    assert {r.doc_id: r.text for r in now.collect()} == kept

    now = stage(1, now)
    gone = dropped(sorted(kept.items()))
    left = {i: "\n".join(b for n, b in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in kept.items()}
    kept = {i: t for i, t in left.items() if t.split()}
    assert now.columns == columns and {r.doc_id: r.text for r in now.collect()} == kept
    assert all(r.n_chars == len(r.text) for r in now.collect())

    now = stage(2, now)
    kept = {i: kept[i] for i, (_, first) in grouped(list(kept.items())).items() if i == first}
    assert now.columns == columns and {r.doc_id: r.text for r in now.collect()} == kept

    now = stage(3, now)
    left = {r.doc_id for r in now.collect()}
    held = {i for i, t in kept.items() if any(b" " + item + b" " in b" " + b" ".join(spaced_seeds.tokens(t)) + b" " for item in items)}
    assert now.columns == columns and left <= set(kept) - held and len(left) >= len(kept) - len(held) - 2

    now = stage(4, now)
    with open(sentencepiece_fst.MODEL, "rb") as file:
        machine = sentencepiece_fst.Transducer(file.read())
    assert now.columns == [*columns, "token_ids"]
    assert all(r.token_ids == machine.encode(r.text) for r in now.collect())


def spaced_seeds_items(spark):
    return [(r.item_id, b" ".join(spaced_seeds.tokens(r.text))) for r in common.table(spark, SF, "benchmark").collect()]


@pytest.mark.parametrize("number", range(5))
def test_edges_of_input(spark, number):
    good = "the quick brown fox jumps over a lazy dog and then runs home again to sleep"
    rows = [(1, good, "en", "s", 3), (1, good, "en", "s", 3), (2, None, None, None, None), (3, "", "en", "s", 0), (None, good + " now", None, "s", 1),
            (4, " ".join(f"w{k * k}" for k in range(60_000)), "en", "s", 9), (5, "\n\n", "en", "s", 2)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, words string, component_id string")
    out = pipeline.STAGES[number][1](spark, docs, SF)
    found = out.collect()
    assert [c for c in out.columns if c != "token_ids"] == docs.columns
    assert all(r.words == "x" and r.component_id == "y" for r in found)
    ids = sorted((r.doc_id for r in found), key=str)
    assert ids == {
        0: [1, 1, 4, None], 1: [2, 3, 4, 5, None], 2: [1, 2, 4, None], 3: [1, 1, 2, 3, 4, 5, None], 4: [1, 1, 2, 3, 4, 5, None],
    }[number]
    assert pipeline.STAGES[number][1](spark, docs.limit(0), SF).count() == 0
