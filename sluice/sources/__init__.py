"""Sources and sinks: CSV and Parquet layers, checkpoints and scratch folders."""
