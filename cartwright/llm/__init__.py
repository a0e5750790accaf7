"""Operators for preparing text corpora for language-model training.

Each module holds one operator with a general interface; ``queries`` applies them to
whole tables. Nothing outside this subpackage imports it, apart from the pipeline at
the top of the repository.
"""
