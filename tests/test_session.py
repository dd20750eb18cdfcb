"""Python workers find the package whatever folder the driver runs in."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from cardlens.operators.neighbours import knn
from cardlens.session import local_session
spark = local_session(cores=2)
rows = [(i, [float(i % 3), float(i // 3)]) for i in range(9)]
found = knn(spark.createDataFrame(rows, "id int, v array<double>"), "id", "v", k=2).count()
assert found == 18, found
spark.stop()
"""


def test_workers_import_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300, check=False)
    assert run.returncode == 0, run.stderr[-2000:]


def test_written_tables_can_be_read_by_many_tasks(spark, monkeypatch):
    """One task's table was one row group, which one task read in every later pass."""
    import pyarrow.parquet as pq
    from cardlens import session

    monkeypatch.setattr(session, "ROW_GROUP_BYTES", 64 << 10)
    table = session.written(spark.range(0, 200_000, 1, 1).selectExpr("id", "md5(cast(id as string)) k"), "groups")
    files = [f.removeprefix("file://") for f in table.inputFiles()]
    assert len(files) == 1 and pq.ParquetFile(files[0]).num_row_groups > 4
    assert table.count() == 200_000
