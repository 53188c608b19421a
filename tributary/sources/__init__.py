"""Sources and sinks: named locations, partitions, file listings, pages, messages."""
