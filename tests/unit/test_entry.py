"""The contract holds with the corpus operators and without them."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
ASK = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), sum(n.startswith('op') for n in q), 'pipeline' in q)"


def asked(folder):
    done = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def test_without_the_corpus_folders(tmp_path):
    for keep_pipeline in (True, False):
        folder = tmp_path / str(keep_pipeline)
        shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if keep_pipeline else ["corpus_pipeline.py"])))
        n, corpus, pipeline = asked(folder)
        assert int(n) > 40 and corpus == "0" and pipeline == "False"
