"""linkspark: Spark-native analytics for schema linking.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions.  Sub-packages:

* ``sources``   - readers / writers (schema catalogs, link files, run logs)
* ``functions`` - column-expression builders (tokeniser, JSON recovery, text rendering)
* ``operators`` - relational operators (canonicalise, vote, score, retrieve, curate, ...)
* ``plans``     - fixture views, size-checked join helpers, the query registry and oracles
* ``streaming`` - Structured Streaming versions of the incremental vote and run metrics
"""

__version__ = "0.1.0"
