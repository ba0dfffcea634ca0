"""Schemas, the merchant category tree, jobs and the driver query set."""
