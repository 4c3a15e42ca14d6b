"""Sources (CSV / Parquet readers, the star-schema adapter) and sinks."""

from servicelens.sources.csv_source import load_assets, load_customers, load_service_lines, as_of_date
from servicelens.sources.star import star_views, star_params
from servicelens.sources.sinks import write_tables

__all__ = [
    "load_assets", "load_customers", "load_service_lines", "as_of_date",
    "star_views", "star_params", "write_tables",
]
