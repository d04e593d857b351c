from fieldmill.streaming.files import (
    run_available,
    start_available,
    stored_schema,
    stream_json,
    stream_parquet,
)
from fieldmill.streaming.medallion import (
    gold,
    in_view_flag,
    silver_device,
    silver_imp,
    silver_site,
)
from fieldmill.streaming.schemas import SchemaLog, merged_type, with_schema

__all__ = [
    "SchemaLog",
    "gold",
    "in_view_flag",
    "merged_type",
    "run_available",
    "silver_device",
    "silver_imp",
    "silver_site",
    "start_available",
    "stored_schema",
    "stream_json",
    "stream_parquet",
    "with_schema",
]
