"""Scans and sinks: settings, cases, vector and raster files, workbooks."""
