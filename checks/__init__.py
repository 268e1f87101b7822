"""Every operator as a query over the given test tables, with the same query in SQL."""
