"""Where written tables go."""

from types import SimpleNamespace

import pytest

from millrace.llm.store import folder, stored


def test_tables_go_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    frame = stored(spark.range(5))
    assert frame.count() == 5
    assert all(shared in f for f in frame.inputFiles())


def _without_setting(spark, **context):
    unset = SimpleNamespace(get=lambda *_: None)
    return SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(**context), _jvm=spark._jvm, _jsc=spark._jsc)


def test_a_local_session_without_the_setting_gets_a_folder(spark, tmp_path):
    held = []
    context = {"master": "local[2]", "setCheckpointDir": held.append, "getCheckpointDir": lambda: (held or [None])[-1]}
    made = folder(_without_setting(spark, **context))
    assert len(held) == 1 and made.startswith(held[0])
    assert folder(_without_setting(spark, **context)).startswith(held[0]) and len(held) == 1


def test_a_cluster_without_the_setting_is_refused(spark):
    with pytest.raises(ValueError, match="executors share"):
        folder(_without_setting(spark, master="spark://x", getCheckpointDir=lambda: None))
