"""Intermediate tables live under the session's checkpoint folder, in fresh folders."""

from matchday.session import checkpoint_root, materialize, scratch_path


def _plain(p):
    p = p[5:] if p.startswith("file:") else p
    return "/" + p.lstrip("/") if p.startswith("/") else p


def test_materialize_writes_below_the_checkpoint_dir(spark):
    root = _plain(checkpoint_root(spark)).rstrip("/")
    assert root == _plain(spark.sparkContext.getCheckpointDir()).rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and _plain(a).startswith(root + "/") and _plain(b).startswith(root + "/")
    df = materialize(spark.range(5), "t")
    files = df.inputFiles()
    assert files and all(_plain(f).startswith(root + "/t-") for f in files)
    assert df.count() == 5
