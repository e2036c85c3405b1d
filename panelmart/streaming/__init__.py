"""Streaming: intentionally empty.

The workload this package re-creates is a scheduled batch job with a full
refresh (monthly, no catch-up); it has no stream, watermark, windowed
aggregation or stateful operator.  A scheduler calls
``panelmart.plans.pipeline.run`` instead.  Nothing is built here so that
no operator exists that the original workload does not have.
"""
