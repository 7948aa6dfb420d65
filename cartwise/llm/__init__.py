"""Training-data operators: deduplication, decontamination, classifiers, token work.

Each module holds one operator with its general interface; ``queries`` derives
the registered ``opN_*`` results from them. Nothing else in the library imports
this package.
"""
