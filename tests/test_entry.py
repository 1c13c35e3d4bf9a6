"""The entry points without the training-data operators, or without what these need."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_missing_dependency():
    code = "import sys, warnings; sys.modules['xxhash'] = None; warnings.simplefilter('ignore'); import __spark_entry__ as e; q = e.queries(); assert 'e_merge_new' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_broken_operators_are_told(tmp_path):
    """Operators that are there and can't be imported give a warning; those that were taken out don't."""
    code = "import sys, warnings; {}; warnings.simplefilter('error'); import __spark_entry__ as e; assert 'e_merge_new' in e.queries()"
    broken = "import ledgerloom.llm.common as c; del c.table"
    run = lambda c: subprocess.run([sys.executable, "-c", c], cwd=ROOT, capture_output=True, text=True, timeout=120, check=False)
    if os.path.exists(os.path.join(ROOT, "ledgerloom", "llm", "common.py")):
        got = run(code.format(broken))
        assert got.returncode and "no training-data operators" in got.stderr
    shutil.copytree(os.path.join(ROOT, "ledgerloom"), tmp_path / "ledgerloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    got = subprocess.run([sys.executable, "-c", code.format("pass")], cwd=tmp_path, capture_output=True, text=True, timeout=120, check=False, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert got.returncode == 0, got.stderr
