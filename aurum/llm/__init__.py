"""Operators of a training-data pipeline (documents, pages, embeddings).

Thirteen operators, one module each, and :mod:`aurum.llm.queries`, which registers
one ``opN_<name>`` query per operator plus ``pipeline``. Nothing else in the
library imports this subpackage.
"""
