"""The entry module without the optional subpackage, and the shared folder."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from corpusloom import session

ROOT = Path(__file__).resolve().parent.parent


def run(folder, *args):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, *args], cwd=folder, env=env, capture_output=True, text=True, timeout=600)


COUNT = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), sum(n.startswith('op') for n in q), 'pipeline' in q, set(s) <= set(q))"


def test_the_rest_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: {"llm", ".git", "__pycache__", "corpus_pipeline.py", ".pytest_cache"} & set(names))
    found = run(copy, "-c", COUNT)
    assert found.returncode == 0, found.stderr
    n, operators, pipeline, known = found.stdout.split()
    assert int(n) > 120 and (operators, pipeline, known) == ("0", "False", "True")
    rest = run(copy, "-m", "pytest", "tests/test_parse.py", "tests/test_text.py", "-q", "-x")
    assert rest.returncode == 0, rest.stdout


@pytest.mark.skipif(not (ROOT / "corpusloom/llm").exists(), reason="needs the subpackage")
def test_a_missing_library_takes_only_the_subpackage():
    whole, without = (run(ROOT, "-c", block + COUNT) for block in ("", "import sys; sys.modules['tiktoken'] = None; "))
    assert whole.returncode == 0 and without.returncode == 0, without.stderr
    assert whole.stdout.split()[1:3] == ["13", "True"] and without.stdout.split()[1:3] == ["0", "False"]


class Fake:
    """A session's master and settings."""

    def __init__(self, master, **settings):
        self.sparkContext, self.conf = self, self
        self.master, self.settings, self.applicationId = master, settings, f"app-{id(self)}"

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_no_machine_has_the_shared_folder():
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(Fake(master))
        assert session.shared_dir(Fake(master, **{"spark.checkpoint.dir": "hdfs://c/"})) == "hdfs://c"
    for master in ("local", "local[*]", "local[4]"):
        local = Fake(master)
        path = session.shared_dir(local)
        assert path.startswith("file://") and session.shared_dir(local) == path
        shutil.rmtree(path.removeprefix("file://"))


def test_a_real_session_without_the_setting():
    """A local session that has no shared folder set writes its tables all the same, and always below one folder."""
    code = """
from corpusloom import session
spark = session.local_session("2", 2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
first, second = session.written(spark.range(5), "a"), session.written(spark.range(7), "b")
assert (first.count(), second.count()) == (5, 7)
assert first.inputFiles()[0].rpartition("/corpusloom/")[0] == second.inputFiles()[0].rpartition("/corpusloom/")[0] == session.shared_dir(spark)
print("fine")
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_CONF_DIR")} | {"SPARK_CONF_DIR": "/nowhere"}
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)
    assert "fine" in found.stdout, found.stderr[-2000:]
