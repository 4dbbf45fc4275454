"""skyframe: weather and air-quality history analytics on Spark DataFrames.

The main entry points, importable from the package:

    from skyframe import clean, select_fields, trend, map_timeline, category_share

Every function takes and returns DataFrames; nothing is collected.
"""

__version__ = "0.1.0"

from .operators.charts import (  # noqa: E402
    avg_temp, category_counts, category_mean, category_share, class_pivot, class_series,
    distinct_values, extents, map_frame, map_piece, map_timeline, rollup_period, timeline, trend,
)
from .operators.clean import clean, impute_group_mean  # noqa: E402
from .operators.ingest import (  # noqa: E402
    dead_letter, dedupe, ingest_pages, insert_batches, mark_batches, missing_targets, route_records,
    split_valid, tagged_union,
)
from .operators.query import (  # noqa: E402
    between_days, day_slice, day_weather, in_district, in_districts, in_period, project, select_fields,
)
from .operators.ranking import first_per_key, global_rank, next_in_group  # noqa: E402
from .sources.pages import page_records, read_pages  # noqa: E402
from .streaming.ingest import ingest_pages_stream, ingest_stream  # noqa: E402

__all__ = [
    "avg_temp", "between_days", "category_counts", "category_mean", "category_share", "class_pivot",
    "class_series", "clean", "day_slice", "day_weather", "dead_letter", "dedupe", "distinct_values",
    "extents", "first_per_key", "global_rank", "impute_group_mean", "in_district", "in_districts",
    "in_period", "ingest_pages", "ingest_pages_stream", "ingest_stream", "insert_batches", "map_frame",
    "map_piece", "map_timeline", "mark_batches", "missing_targets", "next_in_group", "page_records",
    "project", "read_pages", "rollup_period", "route_records", "select_fields", "split_valid",
    "tagged_union", "timeline", "trend",
]
