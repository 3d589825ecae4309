"""The entry without the training-data folders, and without a library that they need."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; names = e.queries().keys() | e.oracle_sql().keys(); print(len(names), sum(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in names))"


def counted(folder: Path, before: str = "") -> list[int]:
    out = subprocess.run([sys.executable, "-c", before + COUNT], capture_output=True, text=True, check=True, cwd=folder)
    return list(map(int, out.stdout.split()))


def test_without_the_folders(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "telemill", tmp_path / "telemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    every, llm = counted(tmp_path)
    assert llm == 0 and every >= 110


def test_without_a_library_of_theirs(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "telemill", tmp_path / "telemill", ignore=shutil.ignore_patterns("__pycache__"))
    hidden = "import sys; sys.modules['public_tokenizers'] = None\n"
    every, llm = counted(tmp_path, hidden)
    assert llm == 0 and every >= 110
