"""Jobs that compose operators, sources and sinks."""
