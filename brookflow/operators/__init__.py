"""Operators on tables of lines, points, network edges and raster cells: DataFrame in, DataFrame out."""
