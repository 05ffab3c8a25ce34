"""Data sources and sinks: text lines, the star-table adapter, the report."""
