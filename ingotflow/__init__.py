"""Keyed business events carried through landing, bronze, silver and gold tables on Spark.

Every transform is ``DataFrame -> DataFrame`` and works on batch and streaming frames alike where
Spark allows it. Only ``sinks``, ``snapshots``, ``streaming`` and ``plans`` touch paths.
"""
