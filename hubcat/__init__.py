"""PySpark-native analytics for model, dataset and paper catalogues.

``functions``  Column -> Column helpers (text, sizes, tags, vectors, ranking)
``operators``  DataFrame -> DataFrame steps (conform, flags, joins, labels, reports)
``sources``    scans, snapshots and sinks
``plans``      the steps chained into complete catalogue tables
"""
