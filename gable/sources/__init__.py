"""Readers and writers."""
from gable.sources.readers import (  # noqa: F401
    PROPERTY_SCHEMA,
    load_data,
    nulls_for_nans,
    read_parquet_parts,
    read_parquet_prefix,
    read_years,
    register_csv_view,
    register_parquet_view,
)
from gable.sources.writers import (  # noqa: F401
    replace_table,
    save_dated_output,
    write_csv,
    write_gzip_parquet,
)
