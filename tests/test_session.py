from __future__ import annotations

import os
import subprocess
import sys

import pytest

from tallymill.session import settings, shared_folder


def test_the_cluster_names_the_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    else:
        assert shared_folder(spark).startswith("file://")


def test_a_local_session_without_the_setting_gets_a_folder(tmp_path):
    script = (
        "from tallymill.session import local_session, shared_folder, written\n"
        "s = local_session(1)\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert shared_folder(s) == shared_folder(s)\n"
        "assert written(s.range(5), 'five').count() == 5\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_settings_return_even_after_an_error(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), settings(spark, {name: "3", "spark.tallymill.unset": "x"}):
        assert spark.conf.get(name) == "3"
        raise RuntimeError
    assert spark.conf.get(name) == before
    assert spark.conf.get("spark.tallymill.unset", None) is None
