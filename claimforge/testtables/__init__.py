"""Claims, members and providers read out of the order tables, and the query catalog."""
