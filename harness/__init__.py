"""Binds the driver's test tables to the warehouse's source shapes and lists the checked queries."""
