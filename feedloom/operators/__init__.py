"""DataFrame -> DataFrame operators of the change pipeline."""
