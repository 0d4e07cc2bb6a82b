"""millrace: record processing for instruction-tuning text, as DataFrame transformations."""

__version__ = "0.1.0"
