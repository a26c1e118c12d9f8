"""Training-data pipeline operators (packing, dedup, language, quality, ...).

Nothing outside this folder imports it; ``corpus_pipeline.py`` and the guarded
import in ``__spark_entry__.py`` are its only users."""
