"""The corpus pipeline, stage by stage, against plain Python on the smallest tables and on planted cases."""

import hashlib
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
from test_documents import hits
from test_jaccard_join import brute
from test_span_operators import PERSONAL_KINDS, expected
from tokenizers import Tokenizer

import __spark_entry__ as contract
from landfall.bindings.registry import table
from landfall.llm.quality_classifier import quality_scores
from landfall.llm.queries import tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    docs = table(spark, SF_DIR, "documents")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF_DIR)
        out.append(made.collect())
        docs = spark.createDataFrame(out[-1], made.schema)
    return out


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_columns_and_rows_in_order(stages):
    for before, after in zip(stages[:4], stages[1:5], strict=True):
        assert all(list(r.asDict()) == COLUMNS for r in after)
        assert 0 < len(after) <= len(before) and set(by_id(after)) <= set(by_id(before))
    assert len(stages[5]) == len(stages[4])


def test_rejected_are_those_of_low_score(spark, stages):
    scores = quality_scores(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    assert {r.doc_id for r in scores.filter("predicted = 1").collect()} == set(by_id(stages[1]))


def test_one_of_each_group_stays(stages):
    groups = brute([(r.doc_id, r.text) for r in stages[1]], 5, 80, 100)
    assert {component for _, _, component in groups} == set(by_id(stages[2]))
    before = by_id(stages[1])
    assert all(before[r.doc_id] == r for r in stages[2])


def test_passages_are_gone(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    before = by_id(stages[2])
    after = by_id(stages[3])
    for i, row in before.items():
        n, hit, *_ = hits(row.text, items, 10)
        if hit > 0.5 * n:
            assert i not in after
        elif not hit:
            assert after[i] == row
        else:
            assert len(after[i].text) < len(row.text) and after[i].n_chars == len(after[i].text)


def test_personal_data_is_masked(stages):
    before = by_id(stages[3])
    for r in stages[4]:
        spans = expected(before[r.doc_id].text, PERSONAL_KINDS)
        if sum(spans[:4]) == 0:
            assert r.text == before[r.doc_id].text
        else:
            assert sum(expected(r.text, PERSONAL_KINDS)[:4]) == 0 and r.n_chars == len(r.text)


def test_ids_are_those_of_the_library(stages):
    library = Tokenizer.from_file(tokenizer_path())
    texts = by_id(stages[4])
    for r in stages[5]:
        text = texts[r.doc_id].text
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_run_gives_the_last_stage(spark, stages):
    found = contract.queries()["pipeline"](spark, SF_DIR)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, stages[5]))


def test_odd_documents_pass_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, words, None, None, 1),
            (3, words, None, None, 1), (4, words + ".", "en", "s", 1), (5, "x" * 200_000, "en", "s", 1)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES[1:]:
            docs = stage(spark, docs, SF_DIR)
            assert docs.count() <= len(rows)
