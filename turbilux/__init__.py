"""Paired-sensor light attenuation analytics on Spark DataFrames.

``functions``  column expressions (times, light, site geometry)
``sources``    logger files, metadata sheets, stored tables
``operators``  DataFrame -> DataFrame building blocks
``plans``      the output tables, composed from the operators
"""

__version__ = "0.1.0"
