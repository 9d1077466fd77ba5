"""The entry point without the training-data subpackage, or without a library that only it needs."""

import os
import subprocess
import sys

import pytest

from hearthlake.plans.queries import registry

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["public_tokenizers", "ahocorasick", "hearthlake.llm", "corpus_pipeline"])
def test_own_queries_stay_when_an_import_fails(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; "
            "print(' '.join(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())")
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120, check=True)
    assert set(out.stdout.split()) >= set(registry())


def test_all_queries_are_there_otherwise():
    pytest.importorskip("hearthlake.llm")
    import __spark_entry__ as entry
    assert {"pipeline", *registry()} < set(entry.queries())
    assert list(entry.queries())[-3:] == list(entry.TUNED)
