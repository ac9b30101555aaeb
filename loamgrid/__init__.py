"""Land-cover raster analytics on Spark: tiles, pixels, regions, grids, changes and evaluation as DataFrames."""
