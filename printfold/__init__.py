"""Catalogue of item printings, built with Spark DataFrames.

``functions``  Column expressions: predicates and scalar rules
``operators``  DataFrame -> DataFrame: flatten, fold, reconcile, load
``sources``    readers and writers: JSON feed, image listing, versioned tables
``plans``      the batch jobs: ingest, audit, publish
``streaming``  the same fold and load on Structured Streaming
``queries``    every operator run on the driver tables, with its SQL twin
"""
