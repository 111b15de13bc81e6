"""Incremental movement of data: watermarks, sync jobs, streaming upserts."""
