"""Operators that prepare large text corpora for training language models.

Each module holds one operator with its general interface; ``queries`` registers a
thin query per operator. Tasks import these modules, so a cluster needs the package
on its workers (``--py-files`` or installed).
"""
