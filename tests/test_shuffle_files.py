"""What a daily run leaves on the executors' disks."""

import time

from starmart.plans.daily import run_daily
from starmart.sources.runs import FILE_CLEANUP
from tests.helpers import D
from tests.test_mart import config, write_sources


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_a_run_deletes_its_shuffle_files(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    setting = spark.conf.get(FILE_CLEANUP, None)
    cfg = config(tmp_path, "shuffles")
    write_sources(spark, cfg, "a", D(2020, 2, 1), ["1", "2"])
    before = _shuffle_files(spark)
    run_daily(spark, cfg, D(2020, 2, 2))
    for _ in range(20):  # they go in the background
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(FILE_CLEANUP, None) == setting
