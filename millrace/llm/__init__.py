"""Training-data operators: ten corpus-scale components and their registered queries.

Nothing else in the library imports this subpackage.
"""
