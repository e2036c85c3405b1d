"""Raw panel sources from files in the source system's layout.

Health, density and area tables as CSV (or Parquet for the area table), the
satellite environment table as CSV with any header case, the
name -> code mapping as CSV and the region polygons as GeoJSON - the inputs
of the original batch job, ready for ``plans.pipeline.run``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from panelmart.schemas import RAW_AREA, RAW_DENSITY, RAW_ENVIRONMENT, RAW_HEALTH, REGION_MAPPING
from panelmart.sources.driver_tables import RawSources
from panelmart.sources.readers import read_csv, read_geojson, read_parquet


def raw_from_files(spark: SparkSession, health: str, density: str, area: str, environment: str,
                   mapping: str, geojson: str, geojson_per_line: bool = False) -> RawSources:
    """Read the six raw inputs with explicit schemas (no inference).

    ``area`` may be a CSV file or a Parquet directory (a workbook must be
    exported to one of them first).  Environment headers are lower-cased on
    read, whatever their case in the file.
    """
    area_df = (read_parquet(spark, area, RAW_AREA) if not area.lower().endswith(".csv")
               else read_csv(spark, area, RAW_AREA))
    return RawSources(
        health=read_csv(spark, health, RAW_HEALTH),
        density=read_csv(spark, density, RAW_DENSITY),
        area=area_df,
        environment=read_csv(spark, environment, RAW_ENVIRONMENT, lowercase=True),
        mapping=read_csv(spark, mapping, REGION_MAPPING),
        features=read_geojson(spark, geojson, per_line=geojson_per_line),
    )
