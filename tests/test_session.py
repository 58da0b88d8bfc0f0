"""Session helpers: sizing, object-store settings, shared checkpoint folder."""

from ledgerlake.session import ensure_checkpoint_dir, object_store_conf, scale_conf, scratch_dir, scratch_scope


def test_scale_conf_sizes_partitions_by_volume_and_cores():
    big = scale_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)
    small = scale_conf(2**30, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16000      # two waves of cores


def test_object_store_conf_carries_no_credentials():
    conf = object_store_conf("http://store:9000")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert not any("key" in k or "secret" in k for k in conf)


def test_scratch_dirs_live_under_the_checkpoint_folder(spark):
    base = ensure_checkpoint_dir(spark)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b


def test_scratch_made_in_a_scope_is_deleted_at_its_end(spark):
    from ledgerlake.sources.tables import path_exists
    kept = scratch_dir(spark, "kept")
    spark.range(3).write.parquet(kept)
    with scratch_scope(spark):
        gone = scratch_dir(spark, "gone")
        spark.range(3).write.parquet(gone)
        assert path_exists(spark, gone)
    assert path_exists(spark, kept) and not path_exists(spark, gone)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_written_step_leaves_no_shuffle_files(spark):
    import time

    from ledgerlake.operators.windows import materialize
    from ledgerlake.session import RELEASE
    before = _shuffle_files(spark)
    kept = materialize(spark.range(1000).repartition(5, "id"), "t-released")
    assert spark.conf.get(RELEASE, None) is None
    for _ in range(50):
        left = {f for f in _shuffle_files(spark) - before if f.endswith(".data")}
        if not left:
            break
        time.sleep(0.2)
    assert not left and kept.count() == 1000


def test_a_step_leaves_what_it_returns(spark):
    from ledgerlake.operators.windows import materialize
    from ledgerlake.session import RELEASE, step_scope
    from ledgerlake.sources.tables import path_exists
    with step_scope(spark):
        path = materialize(spark.range(3), "t-step").inputFiles()[0].rsplit("/", 1)[0]
        assert path_exists(spark, path) and spark.conf.get(RELEASE) == "true"
    assert not path_exists(spark, path) and spark.conf.get(RELEASE, None) is None
