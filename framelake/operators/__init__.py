"""DataFrame -> DataFrame operators of the dataset engine."""
