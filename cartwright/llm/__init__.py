"""Training-data operators (ten of them) and their registered queries.

Nothing else in the library imports this subpackage.  Executors must be able
to import ``cartwright`` (installed, on PYTHONPATH, or shipped as py-files).
"""
