"""Incremental runs.

The reference is batch-only (its file-arrival trigger is disabled and real
time is stated as not required), so there are no streaming operators here -
only an adapter that runs a batch operator over files as they arrive.
"""
