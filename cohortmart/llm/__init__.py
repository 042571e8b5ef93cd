"""Operators of a training-data pipeline.

One module per operator; ``queries`` registers them.  Nothing else in the
package imports this subpackage.
"""
