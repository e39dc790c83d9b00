"""The driver contract's registry is consistent."""

import re
import subprocess
import sys

import __spark_entry__ as E
from conftest import ROOT
from fleetlake.plans import catalog


def test_oracles_belong_to_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_rows_only_queries_are_the_documented_ones():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"file_inventory"}


def test_query_names():
    for name in E.queries():
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)


def test_entry_works_without_the_optional_part():
    """The training-data operators and the pipeline may be missing; nothing else may."""
    code = """
import importlib.abc, sys
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as E
print(len(E.queries()), len(E.oracle_sql()))
"""
    run = lambda names: subprocess.run([sys.executable, "-c", code.format(names=names)], cwd=ROOT,
                                       capture_output=True, text=True)
    found = run(["fleetlake.llm", "corpus_pipeline"])
    assert found.stdout.split() == [str(len(catalog.QUERIES)), str(len(catalog.ORACLES))], found.stderr
    assert run(["numpy"]).returncode != 0
