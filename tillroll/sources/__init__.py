"""Sources (order drops, the driver's star schema) and sinks."""
