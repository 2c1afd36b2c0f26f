"""Session defaults and the shared folder when the environment names none."""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent('''
    import json, sys
    sys.path.insert(0, %(root)r)
    from ledgerlake.session import build_session, shared_dir
    import __spark_entry__ as E
    spark = build_session("local[2]", extra={"spark.sql.shuffle.partitions": "4"})
    spark.sparkContext.setLogLevel("ERROR")
    first, second = shared_dir(spark), shared_dir(spark)
    q = E.queries()
    out = {"preset": spark.conf.get("spark.checkpoint.dir", None), "dir": first,
           "stable": first == second,
           "stream_rows": q["bronze_stream"](spark, %(sf)r).count(),
           "risk_levels": q["gold_risk_summary_local"](spark, %(sf)r).count(),
           "tz": spark.conf.get("spark.sql.session.timeZone"),
           "aqe": spark.conf.get("spark.sql.adaptive.enabled")}
    print(json.dumps(out))
''')


def test_fallback_shared_dir_without_preset(tmp_path):
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path), TMPDIR=str(tmp_path))
    proc = subprocess.run([sys.executable, "-c", SCRIPT % {"root": ROOT,
                                                           "sf": "/root/testdata/sf0.001"}],
                          capture_output=True, text=True, timeout=600, cwd=ROOT, env=env)
    assert proc.returncode == 0, proc.stderr[-3000:]
    out = json.loads(proc.stdout.strip().splitlines()[-1])
    assert out["preset"] is None and out["stable"]
    assert str(tmp_path) in out["dir"]
    assert out["stream_rows"] == 1516 and out["risk_levels"] == 3
    assert out["tz"] == "UTC" and out["aqe"] == "true"


def test_defaults_do_not_override_the_cluster(spark):
    from ledgerlake.session import DEFAULT_CONF, build_session
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    again = build_session()
    assert again is spark
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "snappy"
    spark.conf.set("spark.sql.parquet.compression.codec", DEFAULT_CONF[
        "spark.sql.parquet.compression.codec"])
