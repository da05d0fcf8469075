"""Training-data operators: ten large-scale text and vector jobs on Spark.

Nothing else in the library imports this subpackage; its registered queries are
in ``queries.py`` and the five-stage corpus pipeline in ``corpus_pipeline.py``
at the repository top.
"""
