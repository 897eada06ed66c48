"""Readers, cell cleaning, staging loads and table storage."""
