"""Session settings from outside; the checkpoint folder and scratch tables."""

import os
import subprocess
import sys

import pytest

from promoscope.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self._dir = master, _Conf(conf), None

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_configured_checkpoint_dir_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt"


def test_existing_checkpoint_dir_is_kept():
    s = _Session("k8s://x")
    s.sparkContext.setCheckpointDir("s3a://bucket/ckpt")
    assert ensure_checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_local_master_gets_a_fresh_folder():
    s = _Session("local[4]")
    d = ensure_checkpoint_dir(s)
    assert d and "promoscope-ckpt-" in d


def _in_a_process(code, submit):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS=f"{submit} --conf spark.ui.enabled=false pyspark-shell")
    run = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True,
                         text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    return run.stdout


def test_session_takes_master_and_partitions_from_outside():
    code = ("from promoscope.session import build_session\n"
            "s = build_session()\n"
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'),"
            " s.conf.get('spark.driver.memory'))")
    out = _in_a_process(code, "--master local[2] --driver-memory 700m "
                              "--conf spark.sql.shuffle.partitions=777")
    assert "GOT local[2] 777 700m" in out


def test_passed_settings_win():
    code = ("from promoscope.session import build_session\n"
            "s = build_session('local[3]', 5, config={'spark.sql.adaptive.enabled': 'false'})\n"
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'),"
            " s.conf.get('spark.sql.adaptive.enabled'))")
    assert "GOT local[3] 5 false" in _in_a_process(code, "")


def test_scratch_tables_are_deleted(spark):
    from promoscope.session import clear_scratch, written
    clear_scratch(spark)
    df = written(spark.range(5), "probe")
    path = df.inputFiles()[0].removeprefix("file://")
    assert df.count() == 5 and os.path.exists(path)
    clear_scratch(spark)
    assert not os.path.exists(os.path.dirname(path))
