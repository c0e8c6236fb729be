"""The stack published in the catalog, and the shared folder's rules."""

import pytest
from conftest import SF_SMALL

from svcvitals import session as X
from svcvitals.plans import queries as Q, views as V


def test_published_tables_are_seen_by_another_session(spark):
    stack = Q._stack(spark, SF_SMALL)
    names = V.publish_tables(spark, "vitals", stack)
    other = spark.newSession()
    assert set(names) <= {t.name for t in other.catalog.listTables("vitals")}
    checks = {n: Q.view_checksum(other.table(f"vitals.{n}")).first() for n in names}
    assert checks["composite_health_scores"] == Q.view_checksum(stack.composite()).first()
    assert other.sql("SELECT vitals.get_environment('cloudrun--web-prod') AS e").first().e == "Prod"
    assert V.publish_tables(spark, "vitals", stack) == names
    assert Q.view_checksum(other.table("vitals.raw_metrics")).first() == checks["raw_metrics"]
    spark.sql("DROP DATABASE vitals CASCADE")


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(X, "_checkpoint_root", lambda s: None)
    real = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a: "spark://host:7077" if key == "spark.master" else real(self, key, *a))
    with pytest.raises(RuntimeError):
        X.shared_dir(spark, "x")


def test_shared_folders_are_removed(spark):
    kept = X.shared_dir(spark, "kept")
    spark.range(2).write.parquet(kept)
    with X.own_folders(spark):
        path = X.shared_dir(spark, "gone")
        spark.range(3).write.parquet(path)
    assert spark.read.parquet(kept).count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
