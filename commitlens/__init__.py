"""commitlens: lakehouse commit logs as queryable Spark tables.

Every operator takes and returns DataFrames; settings are keyword
arguments.  Nothing here collects commit data to the driver.
"""

__version__ = "0.1.0"
