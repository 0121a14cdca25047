"""The driver's view: a fresh default session in another working directory."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(f"""
    import importlib.util
    spec = importlib.util.spec_from_file_location("__spark_entry__", "{REPO}/__spark_entry__.py")
    m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.master("local[2]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    assert m.entry(spark).count() > 0
    q = m.queries()
    # queries whose work runs in Python workers (pandas UDF, applyInPandas, keyed state)
    for name in ("community_review_index", "knn_exact", "boot_gender_weight"):
        assert q[name](spark, "/root/testdata/sf0.001").count() > 0, name
    assert set(m.oracle_sql()) <= set(q)
    print("DRIVER-OK")
""")


def test_entry_and_udf_queries_from_foreign_cwd(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env, capture_output=True, text=True,
                       timeout=900)
    assert "DRIVER-OK" in r.stdout, r.stderr[-3000:]
