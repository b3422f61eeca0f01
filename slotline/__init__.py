"""slotline: event and interval analytics as functions from DataFrames to DataFrames."""
