"""Genotype-phenotype association studies as Spark jobs.

Sub-packages
------------
``sources``    readers and writers for variant, phenotype, covariate, result and measurement files
``functions``  column expressions and the numeric kernels that run inside tasks
``operators``  DataFrame -> DataFrame operators
``plans``      the operators chained into the studies people run
``streaming``  the row-wise operators on an unbounded input
"""
