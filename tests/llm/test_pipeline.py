from __future__ import annotations

import json
import os
import subprocess
import sys
from collections import Counter

import corpus_pipeline
from gridlake.llm import decontaminate, mixing, sharding
from gridlake.llm.common import table, written
from tests.conftest import SMALL
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as classes
from tests.llm.test_quality import brute as measured


def test_each_stage_against_plain_python(spark):
    before = table(spark, SMALL, "documents")
    columns = before.columns
    items = [tuple(r) for r in table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, before, SMALL), "test-stage")
        old = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
        new = Counter(r.doc_id for r in after.collect())
        if name != "shards":
            assert after.columns == columns
        if name == "quality_rules":
            n = {i: measured(t) for i, t in old}
            base = {i for i, m in n.items() if m[0] < 10 or 100 * m[4] > 20 * m[0]}
            assert set(new) <= set(n) - base and len(new) > 0.9 * (len(old) - len(base))
        elif name == "near_duplicates":
            assert new == Counter(c for _, c, _ in {(c, c, 0) for _, c, _ in classes(old)})
        elif name == "decontamination":
            assert new == Counter(i for i, t in old if not contaminated(t, items)[-1])
        elif name == "source_mix":
            assert set(new) <= {i for i, _ in old} and max(new.values()) <= mixing.COPIES
            taken = {r.doc_id: r.copies for r in mixing.schedule(before).collect() if r.copies}
            assert new == Counter(taken)
        else:
            assert new == Counter(i for i, _ in old)
            assert after.columns == sharding.assign(before).columns
        before = after


def test_run_leaves_only_its_result(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns[:3] == ["doc_id", "size", "text_crc32"] and out.count() > 50
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before}
    assert left == {"pipeline-shards"}


def test_stages_of_empty_documents(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), "test-stage")
        assert docs.count() == 0


def test_stage_cases(spark, docs):
    bench = table(spark, SMALL, "benchmark")
    assert decontaminate.keep_clean(docs, bench).count() == docs.count()
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, SMALL).columns == docs.columns


def test_contract_without_the_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.mkdir(tmp_path / "gridlake")
    for part in os.listdir(f"{root}/gridlake"):
        if part != "llm":
            os.symlink(f"{root}/gridlake/{part}", tmp_path / "gridlake" / part)
    os.symlink(f"{root}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    code = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    names = []
    for folder in (tmp_path, root):
        said = subprocess.run(
            [sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, check=True,
            env=os.environ | {"PYTHONPATH": str(folder)},
        )
        names.append([set(x) for x in json.loads(said.stdout)])
    (less, less_sql), (full, full_sql) = names
    own = {x for x in full - less}
    assert {"pipeline"} | {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in own}
    assert less_sql == full_sql - own and "solar_share" in less
