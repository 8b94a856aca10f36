"""Plans built from the operators: the medallion pipeline, the star query
layer, report result sets, the legacy summary, diagnostics, analysis."""
