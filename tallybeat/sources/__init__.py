"""Files, tables and the catalog."""
