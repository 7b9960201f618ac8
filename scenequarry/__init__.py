"""Spark-native analytics for 3-D capture tables: splats, cameras, masks, frames, meshes, series and catalogs."""
