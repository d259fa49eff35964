"""Territorial analytics as composable Spark DataFrame operators.

``functions``  Column -> Column expressions (all JVM side)
``sources``    readers, writers and audit columns
``operators``  DataFrame -> DataFrame building blocks
``plans``      bronze / silver / gold / model flows made of the operators
``workload``   the registered queries with their independent SQL checks
"""
