"""crmflow: CRM ingestion, change data capture and type-2 history on Spark.

``operators``  DataFrame -> DataFrame transformations (parse, route, history, quality, queries)
``functions``  Column expressions (JSON values, validation rules)
``sources``    readers and writers (record envelopes, messages, lake tables, the versions table)
``streaming``  Structured Streaming jobs around the same operators
``plans``      the operators applied to the star-schema tables, one plan per named query
"""

__version__ = "0.1.0"
