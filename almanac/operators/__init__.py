"""DataFrame -> DataFrame operators. No collect on the data path."""
