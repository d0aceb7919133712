"""Sources and sinks: survey text formats, Parquet datasets, archives, FITS."""
