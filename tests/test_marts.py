from sparkdesk.operators.marts import resolve_hierarchy
from tests.conftest import rows


def test_hierarchy_episode_season_series_and_trailer(spark):
    content = spark.createDataFrame([
        (100, None), (110, 100), (111, 110),       # series, season, episode
        (500, None), (501, 500),                   # film, trailer
        (900, 777)], "id long, parent long")       # parent not in the table
    got = rows(resolve_hierarchy(content, "id", "parent"), "id", "root_id", "level")
    assert got == [(100, 100, 0), (110, 100, 1), (111, 100, 2), (500, 500, 0), (501, 500, 1), (900, 777, 1)]


def test_payment_mart_keeps_subscriptions(spark):
    from sparkdesk.plans.marts import mart_payment
    df = mart_payment(spark, "/root/testdata/sf0.001")
    subs = df.where("content_id IS NULL")
    assert subs.count() > 0 and subs.where("content_name IS NOT NULL").count() == 0
    assert "device" not in df.columns
