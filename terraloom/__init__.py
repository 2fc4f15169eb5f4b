"""Spark-first engine for earth-observation tables: rasters, swaths, footprints, catalogs and their publication."""
