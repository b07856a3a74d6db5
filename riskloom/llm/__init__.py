"""Training-data pipeline operators on Spark.

One module per operator; ``queries`` registers ``opN_<name>`` for each of them
and ``corpus_pipeline.py`` at the repository top chains five of them. Nothing
else in the library imports this subpackage.
"""
