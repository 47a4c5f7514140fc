"""Training-data operators: scanning, filtering, scoring, mixing, archiving and formatting of text.

Nothing else in the library imports this subpackage.
"""
