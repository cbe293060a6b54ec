from gridspan.catalog import build
from gridspan.catalog import fixtures as X

SMALL = "/root/testdata/sf0.001"


def test_gold_and_inference_join_all_installs_and_weather(spark):
    e, src = X.readings(spark, SMALL), build._sources(spark, SMALL)
    assert src.chargers.count() == e.count()
    assert src.weather.agg({"ts": "count"}).first()[0] > build._sources(spark, SMALL, whole=False).weather.count()
