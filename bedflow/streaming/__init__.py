"""Streaming.

The models are daily batch computations with an explicit ``as_of``; none
of them keeps state across runs, uses watermarks or handles late data, so
no streaming operator is built for them.  The one place where data arrives
continuously is the raw JSON export: ``fhir_landing`` runs the same bulk
ingest incrementally over a landing folder (Structured Streaming file
source + ``foreachBatch``), with no operator of its own.
"""
