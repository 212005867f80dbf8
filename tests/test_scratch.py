from pathlib import Path

from ebbmark.sources.scratch import remove, scratch_folder, scratch_scope


def test_a_scope_removes_what_was_made_in_it(spark):
    outside = scratch_folder(spark)
    spark.range(3).write.parquet(outside)
    with scratch_scope(spark):
        inside = scratch_folder(spark)
        spark.range(3).write.parquet(f"{inside}-part")
        assert spark.read.parquet(f"{inside}-part").count() == 3
        scratch_folder(spark)
    assert not Path(f"{inside}-part").exists() and spark.read.parquet(outside).count() == 3
    remove(spark, outside)
    assert not Path(outside).exists()
