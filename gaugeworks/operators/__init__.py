"""Operators: measures, comparisons, integrity, segmentation, labelling."""
