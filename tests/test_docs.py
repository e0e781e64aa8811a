"""Every registered query is documented in README.md and COVERAGE.md."""

import os

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _read(name):
    with open(os.path.join(ROOT, name)) as f:
        return f.read()


def test_queries_documented():
    readme, coverage = _read("README.md"), _read("COVERAGE.md")
    for name in E.queries():
        assert f"`{name}`" in readme, f"{name} missing from README.md"
        assert f"`{name}`" in coverage, f"{name} missing from COVERAGE.md"
