"""DataFrame -> DataFrame operators; every column they touch is an argument."""
