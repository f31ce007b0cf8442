"""smogcast: daily environmental time-series analytics on Spark.

Every public function takes and returns Spark DataFrames (or Columns) and
names its key/date/value columns explicitly, so the same operator runs on one
station or on millions of keyed series.
"""

from smogcast.session import build_session, ensure_checkpoint_dir  # noqa: F401

SERIES = "series_key"
DATE = "Date"
VALUE = "AQI"
