"""What the plans of the corpus queries have to look like, and how the entry point takes the package."""

from __future__ import annotations

import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sellerlens.llm.registry import llm_queries, llm_sql

SF = "/root/testdata/sf0.001"
NATIVE = ("op2_url_filter", "op3_pii_surrogates", "op9_exact_dedup")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("name", sorted(llm_queries()))
def test_no_cross_join_no_row_udf_no_python_in_native_queries(spark, name):
    text = llm_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert unwanted not in text
    if name in NATIVE:
        assert not re.search("Python|Arrow|Pandas|ExistingRDD", text)


def test_every_statement_belongs_to_a_query():
    assert set(llm_sql()) <= set(llm_queries())


@pytest.mark.parametrize("rows", [0, 3])
def test_stages_of_the_pipeline_take_empty_tables_and_clashing_columns(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(rows)
    clashing = ["row", "body", "new", "n", "carried", "mark", "component_id", "_id", "_mark", "text_key", "entities", "length"]
    docs = docs.select("*", *[F.lit(None).cast("string").alias(c) for c in clashing])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() >= (rows if name == "packing" else 0)
        if name != "packing":
            assert out.columns == docs.columns
            docs = out


@pytest.mark.parametrize("broken", ["tiktoken", "sellerlens.llm"])
def test_entry_goes_on_without_the_package_or_what_it_needs(broken):
    code = f"""
import sys, warnings
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {broken!r}:
            raise ModuleNotFoundError(f"No module named {{name}}", name=name)
sys.meta_path.insert(0, Missing())
with warnings.catch_warnings(record=True) as seen:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
names = entry.queries()
assert "q10_top10" in names and not any(n.startswith("op") for n in names) and set(entry.oracle_sql()) <= set(names)
print(sum("corpus queries" in str(w.message) for w in seen))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip() == ("1" if broken == "tiktoken" else "0")
