"""Stages and the optional part of the driver's entry."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from panelcast import session
from panelcast.session import drop_stage, stage_scope, write_stage

ROOT = Path(__file__).resolve().parent.parent


def there(df):
    return os.path.isdir(df._stage_path.removeprefix("file:"))


def test_scope_deletes_what_it_is_not_told_to_keep(spark):
    before = write_stage(spark.range(3), "before")
    with stage_scope(spark) as scope:
        inner = write_stage(spark.range(5), "inner")
        kept = scope.keep(write_stage(inner, "kept"))
    assert there(before) and there(kept) and not there(inner) and kept.count() == 5
    with pytest.raises(RuntimeError), stage_scope(spark):
        failed = write_stage(spark.range(2), "failed")
        raise RuntimeError
    assert there(failed)
    for df in (before, kept, failed):
        drop_stage(df)
        assert not there(df) and df._stage_path not in session._STAGES


@pytest.mark.parametrize("left", ["nothing", "an empty folder"])
def test_entry_works_without_the_training_data_part(tmp_path, left):
    for name in ("panelcast", "__spark_entry__.py"):
        os.symlink(ROOT / name, tmp_path / name) if name.endswith(".py") else os.mkdir(tmp_path / name)
    for item in (ROOT / "panelcast").iterdir():
        if item.name not in ("llm", "__pycache__"):
            os.symlink(item, tmp_path / "panelcast" / item.name)
    if left == "an empty folder":
        os.makedirs(tmp_path / "panelcast" / "llm" / "__pycache__")
    code = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); print(len(q), len(o), any(n.startswith('op') and n[2].isdigit() for n in q), 'pipeline' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.returncode == 0, out.stderr
    queries, oracles, numbered, pipeline = out.stdout.split()
    assert int(queries) > 80 and int(oracles) > 60 and (numbered, pipeline) == ("False", "False")
