"""Jobs composed of operators, sources and tables."""
