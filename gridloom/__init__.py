"""Gridded weather and climate tables on Spark: DataFrame in, DataFrame out."""
