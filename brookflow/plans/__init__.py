"""Compositions: workflows, views of the driver's tables, and the registered queries."""
