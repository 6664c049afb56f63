"""Sources and sinks: dated snapshots, zipped archives, paged API responses."""
