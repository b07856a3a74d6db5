"""riskloom: a Spark-native credit-risk feature, profiling and scoring library.

Every operator takes and returns a ``pyspark.sql.DataFrame`` and builds a lazy
plan; only small artefacts (vocabularies, column-drop lists, quantile
boundaries, model objects) are ever returned to the driver.
"""

__version__ = "0.1.0"
