"""Pharmacy-claims analytics as plain Spark jobs.

Sub-packages: ``functions`` (Column builders), ``operators`` (DataFrame in, DataFrame
out), ``sources`` (feeds, layers, the star-schema adapter), ``streaming`` (incremental
load), ``plans`` (silver and gold pipelines) and ``checks`` (the registered queries,
each beside the SQL that must give the same rows).
"""
