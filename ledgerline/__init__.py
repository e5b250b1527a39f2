"""Retail medallion pipelines on Spark: CSV landing to silver tables to a star schema.

The public surface is grouped by what a caller does with it:

* ``sources``    read CSV landings and list what was loaded
* ``functions``  column expressions (lenient parsing, masking, calendar parts)
* ``operators``  ``DataFrame -> DataFrame`` steps
* ``plans``      the initial load and the two incremental batches
* ``streaming``  committed tables and the change feeds that maintain them
"""
