"""Session helpers: shared scratch folder and cluster settings."""

from tidewater.session import checkpoint_root, cluster_conf, scratch_path


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b


def test_cluster_settings_enable_adaptive_execution_and_rocksdb():
    conf = cluster_conf(shuffle_partitions=4000)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert conf["spark.sql.shuffle.partitions"] == "4000"
    assert conf["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")
    assert "spark.checkpoint.dir" not in conf   # the cluster names its shared folder


def test_a_plain_session_without_the_setting_works(tmp_path):
    """No spark.checkpoint.dir at all: a local master gets a folder of its own."""
    import os
    import subprocess
    import sys

    from conftest import ROOT, SF_SMALL
    script = tmp_path / "run.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "from tidewater.plans.registry import QUERIES\n"
        f"print('ROWS', QUERIES['session_sum'](spark, {SF_SMALL!r}).count(), QUERIES['json_status_stream'](spark, {SF_SMALL!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k not in ("SPARK_CONF_DIR", "PYSPARK_SUBMIT_ARGS")}
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), capture_output=True, text=True, timeout=300, env=env)
    assert "ROWS 906 799" in out.stdout, out.stderr[-2000:]
