"""The sales and movie models, from raw rows to marts."""
