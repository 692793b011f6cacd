"""User-level jobs composed of operators, and the registered query catalogue."""
