"""Composed plans: fixture adapters, the medallion pipeline, registered queries."""
