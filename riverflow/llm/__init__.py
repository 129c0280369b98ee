"""Training-data operators: one module per operator, ``queries`` registers them.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
