"""DataFrame -> DataFrame operators over the long panel."""
