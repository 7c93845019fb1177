"""Jobs that connect sources, operators, streams and sinks."""
