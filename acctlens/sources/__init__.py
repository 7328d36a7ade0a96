"""Sources and sinks: raw CSV/table readers, driver-table adapters, generated relations."""

from acctlens.sources.raw import (  # noqa: F401
    RawInputs,
    read_raw_csv,
    read_raw_csv_dir,
    read_raw_parquet_dir,
    read_raw_tables,
)
