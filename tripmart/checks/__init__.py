"""Every operator as a query over the driver tables, with the same query in plain SQL."""
