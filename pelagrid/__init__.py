"""Site-suitability analytics on Spark: weather series and rasters to ranked sites."""
