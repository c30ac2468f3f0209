"""Fleet telemetry: the same DataFrame functions over batches and streams."""
