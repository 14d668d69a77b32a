"""Streams and tables as named relations, and SQL text over them.

A second entry to the operators: :func:`name_relations` registers DataFrames,
streaming ones too, as temporary views; the texts below run over those names in
``spark.sql`` and give what the DataFrame forms give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citystream.config import ADVISORY_LEVEL, ADVISORY_SLIDE, ADVISORY_WINDOW, AQI_UNHEALTHY
from citystream.operators.joins import broadcast_if_small


def name_relations(relations: dict[str, DataFrame]) -> None:
    """Register each DataFrame under its name in its session, replacing an older one."""
    for name, df in relations.items():
        df.createOrReplaceTempView(name)


#: A2 + P12 + J2 over the relations ``air_quality`` and ``zone_profile``. A
#: fractional reading is no integer AQI and drops out with the nulls.
ADVISORY_SQL = """
WITH readings AS (
  SELECT zone, CAST(aqi AS BIGINT) AS aqi, event_time
  FROM air_quality
  WHERE aqi = floor(aqi)),
rolling AS (
  SELECT zone, window(event_time, :window, :slide) AS w, avg(aqi) AS rolling_avg_aqi, count(*) AS readings
  FROM readings
  GROUP BY zone, window(event_time, :window, :slide)
  HAVING avg(aqi) > :threshold)
SELECT r.zone, z.zone_name, z.population, z.num_schools, r.w.start AS window_start, r.w.end AS window_end,
       round(r.rolling_avg_aqi, 1) AS rolling_avg_aqi, r.readings, :level AS advisory_level
FROM rolling r JOIN zone_profile z ON r.zone = z.zone
"""


def advisories_by_sql(spark: SparkSession, air: DataFrame, zones: DataFrame, threshold: float = AQI_UNHEALTHY,
                      window: str = ADVISORY_WINDOW, slide: str = ADVISORY_SLIDE) -> DataFrame:
    """The health advisories by SQL text: equal to ``aggregates.health_advisories``
    over tables and over streams (which need a watermark). Readings are added up
    per window in each task before the shuffle."""
    name_relations({"air_quality": air, "zone_profile": broadcast_if_small(zones)})
    return spark.sql(ADVISORY_SQL, {"window": window, "slide": slide, "threshold": float(threshold), "level": ADVISORY_LEVEL})
