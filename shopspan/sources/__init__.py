"""Tables in and out: adapters, staged tables, partitioned and versioned sinks."""
