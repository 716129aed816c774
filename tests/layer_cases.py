"""Shapes and the table folder that several test files use."""

SF = "/root/testdata/sf0.001"
SQUARE = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
BOWTIE = [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]
