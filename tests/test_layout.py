"""The core stands without the llm subpackage, and every query has its name and SQL in order."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_core_does_not_import_llm():
    for p in (ROOT / "lotline").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT / "lotline").parts:
            assert "lotline.llm" not in p.read_text(), p


def test_entry_without_llm(tmp_path):
    shutil.copytree(ROOT / "lotline", tmp_path / "lotline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'p1_found' in q and 'p8_ids' not in q and set(s) <= set(q); print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONDONTWRITEBYTECODE": "1"})
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) > 90


def test_entry_tells_other_import_errors(tmp_path):
    """Only a missing llm subpackage is passed over; a broken import inside it or in the core is an error."""
    shutil.copytree(ROOT / "lotline", tmp_path / "lotline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "lotline/llm").mkdir()
    (tmp_path / "lotline/llm/__init__.py").write_text("")
    (tmp_path / "lotline/llm/queries.py").write_text("import no_such_module\n")
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONDONTWRITEBYTECODE": "1"})
    assert out.returncode != 0 and "no_such_module" in out.stderr


def test_sql_belongs_to_queries():
    from lotline.plans import catalog, problems

    for m in (catalog, problems):
        assert set(m.oracle_sql()) <= set(m.queries())


def test_cut_needs_a_shared_folder():
    """A cluster without a checkpoint folder is an error, not a folder of one machine; a session's own folder is taken."""
    from types import SimpleNamespace

    import pytest

    from lotline import session

    def fake(master, setting):
        at = SimpleNamespace(folder=None)
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: at.folder, setCheckpointDir=lambda f: setattr(at, "folder", f))
        spark = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: setting))
        return SimpleNamespace(sparkSession=spark, checkpoint=lambda eager: at.folder)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.cut(fake("spark://host:7077", None))
    assert session.cut(fake("spark://host:7077", "hdfs://shared")) == "hdfs://shared"
    assert session.cut(fake("local[2]", None))
