"""The CLI jobs: produce -> ingest (stream) -> quality -> gold -> monitor in this
process, and the all-in-one ``run`` as separate processes."""

import json
import os
import subprocess
import sys

from tests.helpers import VALID

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    out = subprocess.run([sys.executable, "-m", "ledgerlake", *args, "--master", "local[2]",
                          "--shuffle-partitions", "4"],
                         cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def _run_here(capsys, *args):
    """The same commands in this process (the session is shared, not stopped)."""
    from ledgerlake.cli import main
    capsys.readouterr()
    assert main(list(args)) == 0
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_jobs_end_to_end(spark, tmp_path, capsys):
    events = [dict(VALID, transaction_id=f"TXN-{i}", amount=1000.0 * (i + 1)) for i in range(8)]
    events += [dict(VALID, transaction_id="TXN-0", amount=1.0),           # duplicate
               dict(VALID, transaction_id="TXN-X", currency="XYZ")]       # invalid
    src = tmp_path / "events.json"
    src.write_text(json.dumps(events, indent=4))
    topic, lake = str(tmp_path / "topic"), str(tmp_path / "lake")
    _run_here(capsys, "produce", "--events", str(src), "--topic-dir", topic, "--topic", "tx")
    got = _run_here(capsys, "ingest", "--stream", "--topic-dir", topic, "--root", lake,
                    "--checkpoint", str(tmp_path / "ckpt"))
    assert got["input_rows"] == 10
    assert got["batches"][0]["processed_rows_per_second"] > 0
    again = _run_here(capsys, "ingest", "--stream", "--topic-dir", topic, "--root", lake,
                      "--checkpoint", str(tmp_path / "ckpt"))
    assert again["input_rows"] == 0
    q = _run_here(capsys, "quality", "--root", lake)
    assert (q["quarantined_records"], q["silver_records"], q["duplicates_removed"]) == (1, 8, 1)
    g = _run_here(capsys, "gold", "--root", lake, "--show")
    assert g["gold_risk_records"] == 8
    m = _run_here(capsys, "monitor", "--root", lake, "--metrics-path", str(tmp_path / "metrics"))
    assert (m["bronze_records"], m["silver_records"], m["quarantined_records"]) == (10, 8, 1)
    assert m["high_risk_transactions"] + m["medium_risk_transactions"] + \
        m["low_risk_transactions"] == 8
    assert m["silver_retention_rate_percent"] == 80.0


def test_run_command_all_jobs(tmp_path):
    events = [dict(VALID, transaction_id=f"TXN-{i}", country="DE" if i % 2 else "US",
                   status="DECLINED", amount=6000.0) for i in range(4)]
    src = tmp_path / "events.json"
    src.write_text(json.dumps(events))
    topic = str(tmp_path / "topic")
    _run("produce", "--events", str(src), "--topic-dir", topic)
    rec = _run("run", "--topic-dir", topic, "--root", str(tmp_path / "lake"),
               "--profile", "cloud", "--metrics-path", str(tmp_path / "m"), "--dedup", "window")
    assert rec["silver_records"] == 4
    assert (rec["high_risk_transactions"], rec["medium_risk_transactions"]) == (2, 2)


def test_stream_ingest_into_catalog_table(spark, tmp_path, capsys):
    src = tmp_path / "events.json"
    src.write_text(json.dumps([dict(VALID, transaction_id=f"TXN-{i}") for i in range(3)]))
    topic = str(tmp_path / "topic")
    _run_here(capsys, "produce", "--events", str(src), "--topic-dir", topic)
    got = _run_here(capsys, "ingest", "--stream", "--topic-dir", topic, "--schema", "cli_cloud",
                    "--profile", "cloud", "--checkpoint", str(tmp_path / "ckpt"))
    assert got["input_rows"] == 3
    table = spark.table("cli_cloud.bronze_transactions_streaming")
    assert table.count() == 3 and "eventhub_offset" in table.columns


def test_batch_jobs_into_catalog_tables(spark, tmp_path, capsys):
    rows = [dict(VALID, transaction_id=f"TXN-{i}", country="GB") for i in range(4)]
    rows.append(dict(VALID, transaction_id="TXN-1", amount=2.0))        # duplicate
    src = tmp_path / "events.json"
    src.write_text(json.dumps(rows))
    topic = str(tmp_path / "topic")
    _run_here(capsys, "produce", "--events", str(src), "--topic-dir", topic)
    common = ["--schema", "cli_tables", "--profile", "cloud"]
    assert _run_here(capsys, "ingest", "--topic-dir", topic, *common)["bronze_records"] == 5
    assert _run_here(capsys, "quality", *common)["silver_records"] == 4
    assert _run_here(capsys, "gold", *common, "--show")["gold_risk_records"] == 4
    m = _run_here(capsys, "monitor", *common)
    assert (m["bronze_records"], m["silver_records"], m["quarantined_records"]) == (5, 4, 0)
    assert spark.table("cli_tables.gold_country_metrics").first().country == "GB"
