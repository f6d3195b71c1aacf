"""Operations of a large-scale training-data pipeline, built on DataFrames.

Nothing else in the library imports this subpackage.
"""
