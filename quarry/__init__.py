"""Medallion analytics on Spark: raw -> staging -> consume as DataFrame plans."""
