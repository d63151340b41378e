"""Sources and sinks: panel from the warehouse tables, CSV/parquet files,
report sinks and the fitted-model store."""

from panelsight.sources.panel import (  # noqa: F401
    build_panel, densify_panel, load_panel, read_table,
)
