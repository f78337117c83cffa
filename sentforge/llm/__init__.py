"""Training-data pipeline operators (dedup, decontamination, packing, classifiers).

Each module holds one operator with its general interface; ``queries`` binds
them to the test tables.  Nothing outside this package imports it.
"""
