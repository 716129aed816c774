"""Column-level building blocks: geometry structs, map projections, rounding helpers."""
