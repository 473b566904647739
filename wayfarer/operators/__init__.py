"""DataFrame -> DataFrame operators over listing tables."""
