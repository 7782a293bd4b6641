"""Reading invoice lines, writing results, and the catalog."""
