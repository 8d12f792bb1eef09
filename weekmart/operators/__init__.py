"""Physical-strategy helpers shared by the plans: size-checked dimension
joins, period filters with scan pushdown, per-period stamping."""
