"""The operators run where the Python workers cannot import this package."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '4')
         .config('spark.sql.session.timeZone', 'UTC').getOrCreate())
from __spark_entry__ import queries
for name in {names!r}:
    print('ROWS', name, queries()[name](spark, '/root/testdata/sf0.001').count())
"""


@pytest.mark.parametrize("names", [["op1_near_dedup", "op4_pii", "op8_pack", "op11_filter_audit", "op13_token_files"],
                                   ["op2_language_id", "op5_word_model", "op6_quality_model", "op10_quality_rules"]])
def test_workers_without_the_package(tmp_path, names):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=ROOT, names=names))
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), capture_output=True, text=True, timeout=1200)
    assert out.stdout.count("ROWS") == len(names), out.stderr[-3000:]
