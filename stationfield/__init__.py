"""Station-based weather analytics on Spark: radius joins, weighted interpolation, versioned tables."""
