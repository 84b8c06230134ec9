"""The stages of the pipeline, each on what the one before kept, against plain Python."""

import pytest

import corpus_pipeline
from parcelflow.llm.shared import written
from test_line_dedup import plainly
from test_secret_scan import plain_spans
from test_simhash import plain_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(written(stage(spark, steps[-1], SF), name))
    return steps


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay_until_the_last_stage(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "secret_scan", "packing"]
    assert all(s.columns == stages[0].columns and s.schema == stages[0].schema for s in stages[:-1])


def test_only_toxic_documents_are_rejected(spark, stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert after.items() <= before.items()
    labels = {r["doc_id"]: r["toxic"] for r in corpus_pipeline.table(spark, SF, "labels").collect()}
    clean = [d for d in before if labels.get(d) == 0]
    assert sum(d in after for d in clean) >= 0.98 * len(clean)


def test_lines_go_and_documents_stay(stages):
    before, after = texts(stages[1]), texts(stages[2])
    assert after == {d: kept for d, _, _, kept in plainly(list(before.items()))}


def test_one_document_of_each_group_stays(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert after == {d: before[d] for d, _, group in plain_groups(list(before.items())) if d == group}


def test_secrets_are_masked(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert before.keys() == after.keys()
    assert not any(plain_spans(t) for t in after.values())
    assert all(after[d] == t for d, t in before.items() if not plain_spans(t) and "[SECRET]" not in after[d])


def test_the_rest_is_packed(spark, stages):
    pieces = stages[5].collect()
    kept = texts(stages[4])
    assert {p["doc_id"] for p in pieces} == kept.keys()
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, pieces))


def test_empty_and_odd_documents_pass_all_stages(spark):
    rows = [(1, None, "n"), (2, "", "n"), (2, "", "n"), (None, "words without an id", "n"), (3, "token=abcdefgh " * 3, None)]
    for docs in (spark.createDataFrame(rows, "doc_id bigint, text string, kept string"), spark.createDataFrame([], "doc_id bigint, text string, kept string")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == ["doc_id", "text", "kept"]
        corpus_pipeline.packed(spark, docs, SF).collect()
