"""Table scans, seed dimensions, fixture views and sinks."""
