"""The entry module with and without the part that may be absent."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(before: str) -> list[str]:
    code = f"import sys; {before}; import __spark_entry__ as e; print(*e.queries())"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()


@pytest.mark.parametrize(
    "gone",
    [
        "sys.modules['corpus_pipeline'] = None",
        "sys.modules['chronotally.llm'] = None",
        "sys.modules['corpus_pipeline'] = sys.modules['chronotally.llm'] = None",
    ],
)
def test_other_queries_stay_when_a_part_is_absent(gone):
    found = names(gone)
    assert "hourly_windows" in found and "pipeline" not in found
    assert not [n for n in found if n.startswith("op") and n[2].isdigit()]


def test_other_missing_modules_are_not_hidden():
    with pytest.raises(subprocess.CalledProcessError):
        names("sys.modules['chronotally.registry'] = None")
