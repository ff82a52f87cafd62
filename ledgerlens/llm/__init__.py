"""Operators of a training-data pipeline, one module each; nothing else in the
library imports this subpackage (``__spark_entry__.py`` adds its queries when
it is there)."""
