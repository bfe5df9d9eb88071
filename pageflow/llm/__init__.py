"""Operators of a training-data pipeline over documents and web pages.

One module per operator. ``catalog`` holds the registered queries, ``oracle``
their SQL where SQL can express them. Nothing else in the library imports this
package.
"""
