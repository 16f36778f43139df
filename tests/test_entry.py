"""The driver contract without the training-data operators, and with one that can't be imported."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
CODE = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') for n in q), len(set(e.oracle_sql()) - set(q)))"


def copy(target):
    shutil.copytree(ROOT / "scoutline", target / "scoutline", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, target / name)


def run(folder):
    return subprocess.run([sys.executable, "-c", CODE], cwd=folder, capture_output=True, text=True)


def test_without_the_operators(tmp_path):
    copy(tmp_path)
    shutil.rmtree(tmp_path / "scoutline/llm", ignore_errors=True)
    (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
    (tmp_path / "scoutline/llm/__pycache__").mkdir(parents=True)  # what a deletion may leave behind
    left = run(tmp_path)
    assert left.returncode == 0, left.stderr
    count, operators, extra = map(int, left.stdout.split())
    assert count > 60 and operators == 0 and extra == 0


def test_a_broken_operator_is_no_missing_one(tmp_path):
    copy(tmp_path)
    if not (tmp_path / "scoutline/llm").exists():
        return  # nothing there that could break
    (tmp_path / "scoutline/llm/warc.py").write_text("from scoutline.llm import nothing_there\n")
    assert run(tmp_path).returncode != 0
