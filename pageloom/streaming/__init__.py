"""The operators on streams. Each batch runs the same functions as a batch job."""
