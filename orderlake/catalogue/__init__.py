"""The operators as named queries over the driver's tables, with their SQL."""
