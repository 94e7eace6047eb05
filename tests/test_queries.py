"""Every registered query against its SQL, and rules for all plans."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from tests.conftest import SF_DIR, plan
from workload.oracle import statements
from workload.queries import REGISTRY

QUERIES = dict(REGISTRY)
SQL = statements()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    text = plan(df)
    assert not re.search("NestedLoop|CartesianProduct|EvalPython|MapInPandas", text), text
    assert difference(df, connect(SF_DIR).sql(SQL[name])) is None


def test_entry_without_the_text_operators_tools():
    """Whatever keeps the text operators from being imported, the relational queries stay."""
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(*e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=Path(contract.__file__).parent, capture_output=True, text=True, check=True)
    assert set(run.stdout.split()) == set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_year_filter_reaches_the_scan(spark):
    text = plan(QUERIES["type_year_long"](spark, SF_DIR))
    scan = next(line for line in text.splitlines() if "lineitem" in line)
    assert "GreaterThanOrEqual(l_shipdate" in scan
    assert "l_comment" not in scan and "l_discount" not in scan


def test_first_row_per_key_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["join_chain_dedup"](spark, SF_DIR))
    assert re.search(r"Exchange hashpartitioning\(numero[^\n]*\n[^\n]*WindowGroupLimit", text)
