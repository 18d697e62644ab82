"""The driver's tables in our shapes, the registered queries, and their SQL twins."""
