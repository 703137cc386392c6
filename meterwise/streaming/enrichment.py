"""The row-wise enrichment steps on a stream of readings.

Every step is an expression or a join with a static table, so no state is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from meterwise.functions.calendar import DEFAULT_ZONE, datetime_features
from meterwise.operators.enrich import add_holiday_flag, add_school_vacation


def enrich_readings(
    readings: DataFrame,
    column: str,
    holidays: DataFrame | None = None,
    periods: DataFrame | None = None,
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Calendar columns, holiday flag and school vacation of each reading, batch or stream."""
    dated = datetime_features(readings, column, zone)
    flagged = add_holiday_flag(dated, column, holidays, zone=zone)
    return add_school_vacation(flagged, column, periods, zone=zone)


def append_to_files(stream: DataFrame, path: str, checkpoint: str, kind: str = "parquet") -> StreamingQuery:
    """Append all available input to a folder; restarts go on from the checkpoint."""
    writer = stream.writeStream.format(kind).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)
