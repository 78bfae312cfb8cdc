"""Sources and sinks (R01-R06) and the driver-table adapter."""

from offblock.sources.files import scan_by_suffix, scan_csv, scan_parquet, sink_csv, sink_parquet  # noqa: F401
from offblock.sources.literal import demo_flights  # noqa: F401
