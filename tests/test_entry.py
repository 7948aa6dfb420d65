"""The store's queries don't depend on the training-data operators or on what only they need."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from cartwise.plans import catalog

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["zstandard", "tokenizers", "cartwise.llm", "corpus_pipeline"])
def test_entry_without_a_module(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None; sys.path.insert(0, {HERE!r}); import __spark_entry__ as e; "
            "print(' '.join(sorted(n for n in e.queries() if n != 'pipeline' and not n.startswith('op'))))")
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True, check=True).stdout
    assert out.split() == sorted(catalog.queries())
