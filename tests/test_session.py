"""Session helpers: pinned settings and scratch folders under the shared checkpoint root."""

from postlytics.session import CLUSTER_CONF, fresh_dir, shared_root


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.python.sql.dataFrameDebugging.enabled") == "false"
    assert int(CLUSTER_CONF["spark.sql.shuffle.partitions"]) > 1000


def test_fresh_dirs_are_unique_and_shared(spark):
    root = shared_root(spark)
    a, b = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert a != b
    app = spark.sparkContext.applicationId
    assert a.startswith(f"{root}/postlytics-{app}-") and b.startswith(f"{root}/postlytics-{app}-")


def test_query_keeps_the_callers_time_zone(spark):
    import __spark_entry__ as entry_mod
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        years = entry_mod.queries()["top_category_by_year"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert sorted(r.post_year for r in years.collect()) == [1996, 1997, 1998, 1999, 2000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sql_over_leaves_no_views(spark):
    from postlytics.sources import sql_over
    before = {t.name for t in spark.catalog.listTables()}
    assert sql_over(spark, {"t": spark.range(3)}, "SELECT count(*) AS n, '{{}}' AS braces FROM {t}").first() == (3, "{}")
    assert {t.name for t in spark.catalog.listTables()} == before
