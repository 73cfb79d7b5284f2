"""waymark: Spark-native geolocation analytics for text observed in public space.

Every operator is a function ``DataFrame -> DataFrame`` or ``Column -> Column``
built from Spark SQL expressions, so Catalyst plans, prunes and pushes down the
whole pipeline. Sub-packages:

* ``functions``  -- column expressions (text cleaning, keys, DMS parsing, distances)
* ``sources``    -- readers and writers (sheet directories, sign/bag tables, model artifacts)
* ``operators``  -- joins, groupings, bootstrap bags, splits, metrics, embedding, fitting, scoring
* ``streaming``  -- continuous guess scoring with Structured Streaming
* ``plans``      -- the fixture views over the driver tables and the query catalogue
"""

__version__ = "0.1.0"
