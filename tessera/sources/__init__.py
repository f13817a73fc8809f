"""Sources, sinks and the catalogue."""
