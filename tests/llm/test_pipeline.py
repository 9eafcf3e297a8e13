import shutil
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from skein.llm.queries import LLM_ORACLES, LLM_QUERIES

from .messy import lower, messy
from .test_phrase_index import brute as brute_contamination
from .test_simhash import brute_fingerprint, joined

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output, each written and read again."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        folder = str(tmp_path_factory.mktemp("stage") / str(at))
        stage(spark, docs, SF_DIR).write.parquet(folder)
        out.append((name, docs.collect(), spark.read.parquet(folder)))
        docs = out[-1][2]
    return out


def test_columns_stay_until_the_last_stage(spark, stages):
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    assert [f.columns for _, _, f in stages[:-1]] == [columns] * 4


def test_each_stage_against_brute_force(spark, stages):
    (_, first, good), (_, before, once), (_, before_near, near), (_, before_clean, clean), (_, last, digests) = stages
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    fine = [r.doc_id for r in first if r.doc_id in labels and labels[r.doc_id].quality and not labels[r.doc_id].toxic]
    assert len(kept & set(fine)) > 0.98 * len(fine) and len(kept) < len(first)

    groups = defaultdict(list)
    for row in before:
        groups[lower(row.text)].append(row.doc_id)
    assert sorted(r.doc_id for r in once.collect()) == sorted(max(g) for g in groups.values())

    prints = {r.doc_id: brute_fingerprint(r.text) for r in before_near}
    tops = joined(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    assert {r.doc_id for r in near.collect()} == set(tops.values())

    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    wanted = {row[0] for row in brute_contamination([(r.doc_id, r.text) for r in before_clean], items) if not row[-1]}
    assert {r.doc_id for r in clean.collect()} == wanted

    assert {r.doc_id for r in digests.collect()} == {r.doc_id for r in last}


def test_messy_documents_pass_all_stages(spark, tmp_path):
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", tmp_path)
    for n in (None, 0):
        docs = messy(spark, n)
        for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
            folder = str(tmp_path / f"{n}-{at}")
            columns = docs.columns
            stage(spark, docs, str(tmp_path)).write.parquet(folder)
            docs = spark.read.parquet(folder)
            assert at == 4 or docs.columns == columns
        assert (docs.count() == 0) == (n == 0)


def test_run_is_the_stages(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SF_DIR).collect()) == sorted(stages[-1][2].collect())


def test_stages_hand_few_rows_to_python_at_once(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def most(batches):
        for batch in batches:
            yield batch.from_pydict({"n": [batch.num_rows]})

    try:
        for asked, wanted in (("10000", 1000), ("0", 1000), ("300", 300)):
            spark.conf.set(name, asked)
            docs = spark.range(2500, numPartitions=1).selectExpr("id as doc_id", "'a' as text")
            for _, stage in corpus_pipeline.STAGES[1:2]:
                stage(spark, docs, SF_DIR)
            assert docs.mapInArrow(most, "n long").agg({"n": "max"}).first()[0] == wanted
    finally:
        spark.conf.set(name, before)


def test_every_operator_is_registered():
    names = {name.split("_")[0] for name in contract.queries() if name.startswith("op")}
    assert {f"op{n}" for n in range(1, 14)} <= names
    assert LLM_ORACLES.keys() <= LLM_QUERIES.keys() <= contract.queries().keys()


def test_the_rest_works_without_these_folders(tmp_path):
    root = Path(contract.__file__).parent
    for name in ("__spark_entry__.py", "skein", "bench.py", "check.py"):
        (shutil.copytree if (root / name).is_dir() else shutil.copy)(root / name, tmp_path / name)
    shutil.rmtree(tmp_path / "skein" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and not any(n.startswith('op1_') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
