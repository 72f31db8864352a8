"""aulastar: a Spark-native medallion / star-schema analytics library.

Raw yearly tabular files -> Bronze (all text, lineage, replace-by-file) ->
Silver (parsed, filtered, deduplicated) -> Gold (dimensions + fact) ->
BI marts and a data-quality suite.  Every step is a DataFrame -> DataFrame
function; the domain is a :class:`aulastar.config.StarConfig` instance.
"""

__version__ = "0.1.0"
