"""The driver contract."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as se


def test_entry_runs(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert {r["split"] for r in rows} <= {"train", "test"}
    assert set(df.columns) == {"split", "num_rows", "mean_src_len", "mean_tgt_len", "max_src_len", "max_tgt_len"}


def test_bucketed_collation_runs_two_python_steps(spark):
    """A core holds one normaliser and one splitter while the tokens are made
    (the filter on lengths adds none), and no Python after that."""
    sf = "/root/testdata/sf0.001"
    plans = [df._jdf.queryExecution().executedPlan().toString()
             for df in (se._tokens(spark, sf), se.queries()["collate_bucketed"](spark, sf))]
    assert [plan.count("EvalPython") for plan in plans] == [2, 0], plans


def test_every_sql_has_a_query():
    q, s = se.queries(), se.oracle_sql()
    assert set(s) <= set(q)
    own = {k for k in q if not k.startswith("op") and k != "pipeline"}
    assert own - set(s) <= {"train_wordpiece"}


@pytest.mark.parametrize("absent", ["twinline.llm", "corpus_pipeline", "xxhash", "public_tokenizers"])
def test_entry_without_the_optional_operators(absent):
    """The core queries are there when the folders, or a package that only they use, are not."""
    code = f"""
import sys, warnings
warnings.simplefilter("ignore")
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {absent!r} or name.startswith({absent!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
import os
import subprocess
import sys

import pytest

import __spark_entry__ as se
names = set(se.queries())
assert "flagship" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(se.oracle_sql()) <= names
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
