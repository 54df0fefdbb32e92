"""parley: conversation-data operators for Spark.

Users, conversations, messages, room events and API requests as DataFrames
and streams; every operator is a DataFrame -> DataFrame (or Column -> Column)
transformation built from Spark SQL built-ins so that Catalyst plans it.
"""

__version__ = "0.1.0"
