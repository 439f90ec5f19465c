"""Session helpers: local core parsing, scratch location, conf profiles."""

from __future__ import annotations

import os

from strata.session import CLUSTER_CONF, DEFAULT_CONF, _local_cores, scratch_path, shared_dir


def test_local_cores():
    assert _local_cores("local[8]") == 8
    assert _local_cores("local[4,4]") == 4
    assert _local_cores("local[*]") == (os.cpu_count() or 1)
    assert _local_cores("local-cluster[3,2,1024]") is None
    assert _local_cores("yarn") is None and _local_cores(None) is None


def test_scratch_paths_are_unique_and_shared(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    assert a.startswith(shared_dir(spark) + "/strata/x-")


def test_conf_keys_are_spark_settings(spark):
    # Every key we set or suggest is a setting Spark knows (a typo would be ignored silently).
    for key in list(DEFAULT_CONF) + list(CLUSTER_CONF):
        assert key.startswith("spark."), key
        if key.startswith("spark.sql."):
            assert spark.conf.isModifiable(key) or spark.conf.get(key, None) is not None, key


def test_ansi_on_in_our_sessions(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
