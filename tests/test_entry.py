"""The entry file without the optional text part."""

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT

SCRIPT = """
import __spark_entry__ as e
names, sql = e.queries(), e.oracle_sql()
assert set(names) == set(sql) and "daily_borough_summary" in names and "pipeline" not in names, sorted(names)
assert not [n for n in names if n.startswith("op")]
print(len(names))
"""


def test_entry_without_the_text_part(tmp_path):
    from tiertrip.plans import registry
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py")
    for drop_pipeline in (False, True):
        place = tmp_path / str(drop_pipeline)
        shutil.copytree(ROOT, place, ignore=skip)
        if not drop_pipeline:  # the pipeline's file may be left behind
            (place / "corpus_pipeline.py").write_text("import tiertrip.llm\n")
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=place, env={**os.environ, "PYTHONPATH": str(place)},
                             capture_output=True, text=True, timeout=120)
        assert out.returncode == 0, out.stderr
        assert int(out.stdout) == len(registry.QUERIES)
