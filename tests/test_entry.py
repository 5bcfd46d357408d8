"""The driver's entry works without the training-data modules."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(at: Path) -> set[str]:
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(' '.join(q))"
    return set(subprocess.run([sys.executable, "-c", code], cwd=at, capture_output=True, text=True, check=True).stdout.split())


def test_queries_without_the_llm_folders(tmp_path):
    shutil.copytree(ROOT, tmp_path / "a", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    with_pipeline = names(tmp_path / "a")
    (tmp_path / "a" / "corpus_pipeline.py").unlink(missing_ok=True)
    assert with_pipeline == names(tmp_path / "a") and "split_counts" in with_pipeline and not {n for n in with_pipeline if n.startswith("op")}
    assert with_pipeline <= names(ROOT)
    text = "\n".join(p.read_text() for p in (ROOT / "millrace").rglob("*.py") if "llm" not in p.parts)
    assert "millrace.llm" not in text
