"""Listing-event lakehouse on Spark: raw listing observations to trusted tables.

Stages, each a plain DataFrame transformation:

* ``sources``    Kafka, file drops, search-response pages, the bronze stream
* ``operators``  normalise, envelope, decode, validate, flatten, aggregate, report
* ``tables``     keyed upsert, insert-if-absent, replace-days, compaction, pruning
* ``streaming``  the checkpointed bronze and silver jobs
* ``plans``      the batch ingest and gold jobs
"""
