"""Jobs and registered queries put together from sources, operators and sinks."""
