"""Training-data operators: one module per operator, ``queries`` registers them.

Nothing else in the library imports this subpackage.  Every operator reads only
the columns it names, so extra input columns never clash with internal ones.
"""
