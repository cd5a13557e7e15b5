"""Training-data pipeline operators.  Nothing outside this folder, ``tests/llm``
and ``corpus_pipeline.py`` imports them."""
