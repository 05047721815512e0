"""Checks that read changed partitions only."""

import glob
import os

import pytest

from starmart.operators.check_ledger import run_changed
from starmart.operators.checks import CheckSpec, run_suite

SPECS = [CheckSpec("v_not_null", "t", "not_null", "v"), CheckSpec("v_range", "t", "accepted_range", "v", args={"min_value": 2, "max_value": 50})]


def test_only_changed_partitions_are_read(spark, tmp_path):
    path, ledger = str(tmp_path / "t"), str(tmp_path / "ledger")
    table = lambda rows: spark.createDataFrame(rows, "m int, v long")
    rows = [(m, None if k == 3 else m * k) for m in range(1, 8) for k in range(10)]
    table(rows).repartition("m").write.partitionBy("m").parquet(path)

    def run(specs=SPECS):
        return {r["check_name"]: r["n_failed"] for r in run_changed(spark, path, "m", specs, ledger).collect()}

    def whole(rows, specs=SPECS):
        return {r["check_name"]: r["n_failed"] for r in run_suite(specs, {"t": table(rows)}).collect()}

    assert run() == whole(rows) and sum(run().values()) > 0
    assert len(os.listdir(ledger)) == 1  # nothing changed: no new version
    # month 4 gets other rows, month 9 is new, month 7 goes; the other months can't be read any more
    rows = [(m, v) for m, v in rows if m not in (4, 7)] + [(4, None), (4, 1000), (9, 1)]
    for f in glob.glob(f"{path}/m=4/*.parquet") + glob.glob(f"{path}/m=7/*"):
        os.remove(f)
    os.remove(f"{path}/m=7/._SUCCESS.crc") if os.path.exists(f"{path}/m=7/._SUCCESS.crc") else None
    for f in glob.glob(f"{path}/m=7/.*"):
        os.remove(f)
    os.rmdir(f"{path}/m=7")
    table([r for r in rows if r[0] in (4, 9)]).write.mode("append").partitionBy("m").parquet(path)
    times = {}
    for f in glob.glob(f"{path}/m=[12356]/*.parquet"):
        times[f] = (os.stat(f), open(f, "rb").read())
        with open(f, "wb") as g:
            g.write(b"x" * len(times[f][1]))
        os.utime(f, ns=(times[f][0].st_atime_ns, times[f][0].st_mtime_ns))
    assert run() == whole(rows)
    for f, (stat, content) in times.items():
        with open(f, "wb") as g:
            g.write(content)
        os.utime(f, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    # a changed check is counted again everywhere, the other results stay
    other = [SPECS[0], CheckSpec("v_range", "t", "accepted_range", "v", args={"min_value": 5})]
    assert run(other) == whole(rows, other)
    # a version without its success file doesn't count
    os.makedirs(f"{ledger}/v99")
    assert run(other) == whole(rows, other)
    with pytest.raises(ValueError):
        run([CheckSpec("u", "t", "unique", "v")])


def test_empty_table(spark, tmp_path):
    got = run_changed(spark, str(tmp_path / "none"), "m", SPECS, str(tmp_path / "ledger")).collect()
    assert [r["n_failed"] for r in got] == [0, 0]
