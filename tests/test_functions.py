import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


# distances from the spherical law of cosines, worked out apart
@pytest.mark.parametrize(
    "points, km",
    [((64.1466, -21.9426, -33.9249, 18.4241), 11463.579697), ((0.0, 179.5, 0.0, -179.5), 111.194927), ((89.0, 10.0, 89.0, -170.0), 222.389853), ((40.0, -3.0, 40.0001, -3.0), 0.01112),
     ((-12.0464, -77.0428, 55.7558, 37.6173), 12644.205027), ((51.5, 7.25, 51.5, 7.25), 0.0)],
)
def test_distance(spark, points, km):
    got = spark.range(1).select(S.haversine_km(*(F.lit(p) for p in points))).first()[0]
    assert got == pytest.approx(km, abs=1e-5)


def test_rounding_and_hours(spark):
    rows = spark.createDataFrame([(2.345, 1_700_000_000_000), (-2.5, 0)], "x double, ms long")
    got = rows.select(S.round_half_up(F.col("x"), 0).alias("r"), S.local_hour(F.col("ms")).alias("h")).collect()
    assert [tuple(r) for r in got] == [(2.0, 5), (-2.0, 12)]


def test_places(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (10.0, 106.0), (95.0, 1.0), (0.0, 5.0)], "lat double, lon double")
    got = rows.select(S.valid_coordinates(F.col("lat"), F.col("lon")).alias("v"), S.is_foreign(F.col("lat"), F.col("lon")).alias("f")).collect()
    assert [tuple(r) for r in got] == [(False, 1), (True, 0), (False, 1), (True, 1)]


def test_non_blank(spark):
    rows = spark.createDataFrame([("a",), (" ",), (None,)], "x string")
    assert [r[0] for r in rows.select(S.non_blank(F.col("x"), "d")).collect()] == ["a", "d", "d"]
