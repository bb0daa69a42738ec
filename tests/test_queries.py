"""Every query of the engine's own against its SQL."""

import pytest

from reelquery.plans.queries import ORACLES, QUERIES

from .oracle import same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, name):
    same(QUERIES[name](spark, sf), ORACLES[name], sf)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_works_without_the_llm_package():
    """The guard in the entry module lets everything else import."""
    import subprocess
    import sys
    from pathlib import Path

    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, *_):\n"
        "        if name == 'corpus_pipeline' or name.startswith('reelquery.llm'):\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'kis' in e.queries() and 'pipeline' not in e.queries() and e.oracle_sql()\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)
