"""The driver contract loaded by path, from another folder."""

import subprocess
import sys
from pathlib import Path

ENTRY = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
LOAD = f"""
import importlib.util, sys
{{before}}
spec = importlib.util.spec_from_file_location("driver_entry", {str(ENTRY)!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
names = set(entry.queries())
"""


def run(code, folder, before=""):
    script = LOAD.format(before=before) + code
    return subprocess.run([sys.executable, "-c", script], cwd=folder, capture_output=True, text=True, timeout=300)


def test_loads_from_another_folder(tmp_path):
    found = run("assert 'd2_dim_members' in names and set(entry.oracle_sql()) <= names; print('loaded')", tmp_path)
    assert "loaded" in found.stdout, found.stderr


def test_loads_without_the_tokenizer_files(tmp_path):
    code = "assert 'd2_dim_members' in names and not [n for n in names if n.startswith('op')]; print('loaded')"
    found = run(code, tmp_path, "sys.modules['public_tokenizers'] = None")
    assert "loaded" in found.stdout, found.stderr
