from __future__ import annotations

from types import SimpleNamespace

from tidemark.session import workspace


def test_workspace_follows_the_shared_folder():
    settings = {"spark.checkpoint.dir": "hdfs://shared/dir/"}
    session = SimpleNamespace(conf=settings)
    first, second = workspace(session, "x"), workspace(session, "x")
    assert first.startswith("hdfs://shared/dir/tidemark-x-") and first != second


def test_workspace_without_one_is_local(spark):
    assert "tidemark-x-" in workspace(spark, "x")
