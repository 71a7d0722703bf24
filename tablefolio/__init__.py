"""Portfolio-report analytics on Spark: page selection, table rebuilding, column matching,
row normalisation, validation, company matching and usage analytics as DataFrame jobs."""
