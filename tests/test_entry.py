"""The entry point with and without the optional subpackage, and scratch tables that are removed."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from oreflow.sources import scratch

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def imported(hidden: str) -> subprocess.CompletedProcess:
    code = f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    return subprocess.run([sys.executable, "-c", code], cwd=TOP, capture_output=True, text=True, timeout=120, check=False)


@pytest.mark.parametrize("hidden", ["oreflow.llm", "corpus_pipeline"])
def test_the_rest_is_offered_without_the_subpackage(hidden):
    from oreflow.plans.catalog import catalog

    assert imported(hidden).stdout.split() == [str(len(catalog()))] * 2


def test_a_missing_library_is_no_absent_subpackage():
    if not os.path.exists(os.path.join(TOP, "oreflow", "llm", "registry.py")):
        pytest.skip("the subpackage is not here")
    found = imported("zstandard")
    assert found.returncode and "zstandard" in found.stderr


def test_only_results_stay(spark):
    with scratch.only_results(spark) as written:
        inner = scratch.written(spark.range(5), "inner")
        result = written(inner.select((F.col("id") * 2).alias("id")), "result")
        paths = scratch._written[-2:]
    assert sorted(r.id for r in result.collect()) == [0, 2, 4, 6, 8]
    assert not os.path.exists(paths[0].removeprefix("file:")) and os.path.exists(paths[1].removeprefix("file:"))
    with pytest.raises(ZeroDivisionError), scratch.only_results(spark):
        scratch.written(spark.range(5), "inner")
        path = scratch._written[-1]
        raise ZeroDivisionError
    assert not os.path.exists(path.removeprefix("file:")) and path not in scratch._written
