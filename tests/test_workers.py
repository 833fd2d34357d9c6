"""Python workers of a cluster have numpy and pandas, but not necessarily this package."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
    import sys
    sys.path.insert(0, {ROOT!r})
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "2").getOrCreate())
    from featurelab.operators.scale import apply_scaler, fit_scaler
    df = spark.range(0, 101, 1, 2).selectExpr("id", "cast(id as double) as x")
    out = apply_scaler(df, fit_scaler(df, ["x"], "quantile", n_quantiles=11))
    assert out.filter("abs(x - id / 100) > 1e-9").count() == 0
    print("same")
"""


def test_quantile_scaling_outside_the_source_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(SCRIPT)], cwd=tmp_path, env=env, capture_output=True,
        text=True, timeout=300,
    )
    assert done.stdout.strip().endswith("same"), done.stderr[-3000:]
