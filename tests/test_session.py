import os

import pytest

from shelfmark import session


def test_scratch_removes_what_was_stashed(spark, tmp_path):
    with session.scratch(spark):
        kept = session.stash(spark.range(5), "inside")
        path = kept.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        with session.scratch(spark):
            assert session.stash(kept.filter("id > 2"), "deeper").count() == 2
        assert os.path.exists(path)
        kept.write.parquet(str(tmp_path / "out"))
    assert not os.path.exists(path) and spark.read.parquet(str(tmp_path / "out")).count() == 5
    outside = session.stash(spark.range(3), "outside")
    assert outside.count() == 3
    session.drop_stash(outside)


def test_only_one_process_may_do_without_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = spark.conf, Context()

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="checkpoint"):
            session.shared_dir(Session())


def test_drop_path_refuses_other_folders(spark):
    with pytest.raises(ValueError, match="not a stash"):
        session.drop_path(spark, "/tmp/elsewhere")
