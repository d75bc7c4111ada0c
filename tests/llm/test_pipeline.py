"""Every stage of the pipeline against a plain computation on its own input."""

from __future__ import annotations

import os
import subprocess
import sys

import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tests.llm import plain, test_native
from tests.llm.conftest import SF_DIR, edge_rows
from tidings.llm import mixing, secrets
from tidings.session import stage


def test_registered():
    queries = entry.queries()
    assert queries["pipeline"] is pipeline.run
    assert [sum(n.startswith(f"op{i}_") for n in queries) for i in range(1, 14)] == [1] * 13
    assert len(pipeline.STAGES) == 5 and "pipeline" not in entry.oracle_sql()


def test_a_broken_module_is_not_hidden():
    program = "import sys\nsys.modules['tidings.llm.mixing'] = None\nimport __spark_entry__"
    root = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run([sys.executable, "-c", program], cwd=root, capture_output=True, text=True)
    assert done.returncode and "tidings.llm.mixing" in done.stderr


def run_stages(spark, docs, sf_dir):
    out = [docs]
    for name, function in pipeline.STAGES:
        out.append(stage(function(spark, out[-1], sf_dir), "test"))
    return out


@pytest.fixture(scope="module")
def stages(spark):
    return run_stages(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR)


def test_columns_stay(stages):
    for table in stages[1:-1]:
        assert table.columns == stages[0].columns


def test_quality_keeps_clean_documents(stages):
    kept = {r.doc_id for r in stages[1].collect()}
    for r in stages[0].collect():
        n_words, _, _, _, repeated = test_native.measured(r.text)
        assert (r.doc_id in kept) == (n_words >= 50 and 100 * repeated <= 50 * n_words)


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    heads = plain.components(rows, 80)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(set(heads.values()))


def test_secrets_go(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    for r in stages[3].collect():
        assert not secrets.base_spans(r.text)
        assert (r.text != before[r.doc_id]) == ("[SECRET]" in r.text)


def test_mixture(stages):
    total = sum(len(plain.words(r.text)) for r in stages[3].collect())
    mixed = stages[4].collect()
    sources = len({r.source for r in mixed})
    assert abs(sum(len(plain.words(r.text)) for r in mixed) - total) < 2 * sources * mixing.BLOCK_WORDS


def test_encoded(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = sorted((r.doc_id, library.encode(r.text)) for r in stages[4].collect())
    assert sorted((r.doc_id, r.ids) for r in stages[5].collect()) == texts


def test_run_equals_its_stages(spark, stages):
    assert sorted(str(tuple(r)) for r in pipeline.run(spark, SF_DIR).collect()) == sorted(
        str(tuple(r)) for r in stages[5].collect())


def test_edge_and_empty(spark, edge, empty):
    out = run_stages(spark, edge, "")
    assert [t.schema for t in out[1:-1]] == [edge.schema] * 4
    assert {r.doc_id for r in out[-1].collect()} <= {r[0] for r in edge_rows()}
    assert [t.count() for t in run_stages(spark, empty, "")] == [0] * 6
