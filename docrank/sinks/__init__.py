"""Index and result sinks."""
