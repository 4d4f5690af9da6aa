"""Job plans: request manifests, end-to-end ingest jobs and the registered
queries over the driver tables."""
