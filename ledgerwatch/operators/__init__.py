"""DataFrame -> DataFrame operators; only the gates in ``quality`` trigger a job."""
