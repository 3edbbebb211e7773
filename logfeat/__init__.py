"""Log features and scoring as plain DataFrame functions.

A log ``(entity, actor, product, us, rid)`` and a table of entities
``(entity, target, fold)`` go in; feature tables, sparse matrices, scores and
blends come out.  See README.md for the column contract.
"""
