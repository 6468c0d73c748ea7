"""DataFrame -> DataFrame building blocks; no driver-side data, no Python UDFs."""
