"""Logical plans: period algebra, the star-schema cube, the weekly summary
and the run manifest."""
