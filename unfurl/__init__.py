"""unfurl: Spark-native operators for nested order data and JSON/text operation logs.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function built
from Catalyst-visible expressions, so jobs composed from them run unchanged as
batch queries or as Structured Streaming queries.
"""

__version__ = "0.1.0"
