"""Command line entry points (in-process, sharing the test session)."""

from conftest import SF_SMALL
from hearthlake.__main__ import main


def test_query_command(spark, capsys):
    assert main(["query", "gold_supplier_risk", "--tables-dir", SF_SMALL, "--show", "3"]) == 0
    out = capsys.readouterr().out
    assert "ingredient_criticality_score" in out and "only showing top 3 rows" in out
