"""Sources: literal tables, file scans, layer read-back, fixtures, generators."""
