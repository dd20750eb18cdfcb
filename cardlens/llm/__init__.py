"""Training-data pipeline operators (URL filter, decontamination, PII, ...).

Nothing outside this subpackage imports it, apart from the guarded registration in
``__spark_entry__.py`` and the pipeline script beside it.
"""
