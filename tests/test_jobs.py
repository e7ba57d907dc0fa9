"""Messages in, reports out: all jobs one after the other, in two portions."""

import os
import tempfile

from payguard import jobs
from payguard.sources import derived, messages


def portion(payments, root, name, condition):
    folder = f"{root}/messages"
    lines = [r["value"] for r in messages.encode(payments.filter(condition)).select("value").collect()]
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_from_messages_to_reports(spark, sf_dir, capsys):
    root = tempfile.mkdtemp()
    payments = derived.payments(spark, sf_dir)
    total = payments.count()
    duplicates = payments.filter("retry_count > 0").count()
    for name, condition in (("1", "retry_count < 2"), ("2", "retry_count >= 2")):
        portion(payments, root, name, condition)
        for job in ("bronze", "dedup"):
            jobs.main(["--root", root, job, "--files", f"{root}/messages"])
        jobs.main(["--root", root, "gold", "merchant", "sla", "customer", "system"])
    got = {name: df.collect() for name, df in jobs.reports(spark, root).items()}
    summary = got["summary"][0]
    assert (summary["bronze_total"], summary["silver_total"], summary["rejected"]) == (total, total, duplicates)
    assert summary["flagged_customers"] > 0
    assert got["payments missing in a layer"] == []
    recall = got["precision and recall"][0]
    assert (recall["fp"], recall["fn"], recall["precision"], recall["recall"]) == (0, 0, 1.0, 1.0)
    gold = spark.read.parquet(f"{root}/gold/merchant").agg({"total_payments": "sum"}).first()[0]
    assert gold == total
    system = spark.read.parquet(f"{root}/gold/system").agg({"total_events_received": "sum"}).first()[0]
    assert system == total
    assert jobs.run_gold(spark, root, ["merchant"]) == {"merchant": 0}
    jobs.main(["--root", root, "recon"])
    assert "overall_status" in capsys.readouterr().out
    assert spark.read.parquet(f"{root}/recon/duplicate_rate_by_merchant").count() == 10


def test_the_documented_command_starts():
    import subprocess
    import sys

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-m", "payguard.jobs", "--help"], cwd=here, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "recon" in done.stdout


def test_a_job_runs_from_the_zipped_package(tmp_path):
    """As a cluster gets it: the package as one archive, a process of its own for each job."""
    import shutil
    import subprocess
    import sys

    from test_tables import GOOD

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(str(tmp_path / "payguard"), "zip", here, "payguard")
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "1.txt").write_text("\n".join([GOOD % "a", GOOD % "b", "no json"]) + "\n")
    env = {**os.environ, "PYTHONPATH": archive, "PYSPARK_SUBMIT_ARGS": f"--py-files {archive} --conf spark.ui.enabled=false --conf spark.checkpoint.dir={tmp_path}/shared pyspark-shell"}
    run = [sys.executable, "-c", "from payguard.jobs import main; main()", "--root", str(tmp_path / "root")]
    for job in (["bronze", "--files", str(tmp_path / "in")], ["dedup", "--files", str(tmp_path / "in")], ["gold", "merchant", "--mode", "merge"]):
        done = subprocess.run([*run, *job], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
    assert "{'merchant': 1}" in done.stdout
    assert os.path.isdir(tmp_path / "root" / "silver_ids") and os.path.isdir(tmp_path / "root" / "counters")
