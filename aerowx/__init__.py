"""aerowx — observation-window analytics on Spark.

Attaches to each scheduled trip the complete, time-ordered window of hourly
station observations before its departure (at the origin) and before its
arrival (at the destination), widens the result into a learning table, and
trains / evaluates a random-forest delay classifier.

Everything is expressed with the DataFrame API, built-in column expressions
and Spark ML; there are no Python UDFs on the data path.

Sub-packages
------------
``functions``   column expressions (time construction, sentinel cleaning)
``operators``   DataFrame -> DataFrame building blocks
``sources``     CSV / Parquet readers and writers, driver-table adapters
``plans``       end-to-end preprocess and learning plans, query catalog
``streaming``   the window attach over a streaming trip source
"""

__version__ = "0.1.0"
