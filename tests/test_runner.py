"""Resumable runs: what was committed is never run again."""
import os
import tempfile

import pytest

from estuary.operators import runner as RN

SCHEMA = "id long, square long"


def _task(log, broken):
    """Squares of the ids; writes down every id it runs, and fails at ``broken`` as long as the flag file is there."""
    def run(batches):
        import os
        import uuid

        for b in batches:
            for i in b["id"].tolist():
                if i == broken and os.path.exists(f"{log}/flag"):
                    os.remove(f"{log}/flag")
                    raise RuntimeError("the executor is gone")
                open(f"{log}/{i}-{uuid.uuid4().hex}", "w").close()
            yield b[["id"]].assign(square=b["id"] ** 2)

    return run


def _runs(log):
    out = {}
    for f in os.listdir(log):
        if "-" in f:
            out[int(f.split("-")[0])] = out.get(int(f.split("-")[0]), 0) + 1
    return out


def _slice_of(folder, spark, i):
    files = {}
    for r in spark.read.parquet(f"{folder}/slices").selectExpr("id", "input_file_name() f").collect():
        files.setdefault(r.f, set()).add(r.id)
    return next(ids for ids in files.values() if i in ids)


def test_a_failed_task_runs_no_finished_id_again(spark):
    folder, log = tempfile.mkdtemp(prefix="run-"), tempfile.mkdtemp(prefix="log-")
    open(f"{log}/flag", "w").close()
    todo = spark.range(60)
    task = _task(log, broken=41)
    with pytest.raises(Exception, match="executor is gone"):
        RN.run_resumable(todo, "id", task, SCHEMA, folder, slices=10, slices_per_commit=1)
    own = _slice_of(folder, spark, 41)
    out = RN.run_resumable(todo, "id", task, SCHEMA, folder, slices=10, slices_per_commit=1)
    assert sorted((r.id, r.square) for r in out.collect()) == [(i, i * i) for i in range(60)]
    runs = _runs(log)
    assert runs.keys() == set(range(60))
    assert all(n == 1 for i, n in runs.items() if i not in own)  # only the broken slice may start anew


def test_new_rows_are_added_and_old_ones_kept(spark):
    folder, log = tempfile.mkdtemp(prefix="run-"), tempfile.mkdtemp(prefix="log-")
    task = _task(log, broken=-1)
    assert RN.run_resumable(spark.range(10), "id", task, SCHEMA, folder, slices=4).count() == 10
    assert RN.run_resumable(spark.range(25), "id", task, SCHEMA, folder, slices=4).count() == 25
    assert RN.run_resumable(spark.range(25), "id", task, SCHEMA, folder, slices=4).count() == 25
    assert _runs(log) == dict.fromkeys(range(25), 1)


def test_empty_table(spark):
    out = RN.run_resumable(spark.range(0), "id", _task("/nowhere", -1), SCHEMA, tempfile.mkdtemp(prefix="run-"))
    assert out.collect() == [] and out.columns == ["id", "square"]
