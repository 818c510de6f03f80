import os

import pytest

from spendwatch.session import cut_lineage, release_scratch, scratch_mark, scratch_path, shared_dir


def test_stages_go_to_the_named_folder_and_can_be_released(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder
    kept = cut_lineage(spark.range(10))
    assert kept.count() == 10 and all(f"{folder}/stage-" in f for f in kept.inputFiles())
    path = scratch_path(spark, "made")
    spark.range(1).write.parquet(path)
    release_scratch(spark)
    assert not os.path.exists(path)


def test_scratch_since_a_mark_goes_but_for_the_newest(spark):
    before = cut_lineage(spark.range(3))
    mark = scratch_mark()
    first, second = cut_lineage(spark.range(4)), cut_lineage(spark.range(5))
    release_scratch(spark, mark, keep_last=True)
    assert before.count() == 3 and second.count() == 5
    with pytest.raises(Exception, match="(?i)not.*exist|not_exist"):
        first.count()
    release_scratch(spark, mark)
    with pytest.raises(Exception, match="(?i)not.*exist|not_exist"):
        second.count()
