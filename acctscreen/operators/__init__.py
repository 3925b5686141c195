"""DataFrame -> DataFrame operators of the screening job."""
