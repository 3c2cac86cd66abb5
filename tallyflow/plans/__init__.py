"""Jobs that run operators over the stored tables, and the catalog of named queries."""
