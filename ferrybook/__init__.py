"""Record exchange on Spark: fixed-width intake, rule checks, conversion, export, deadlines."""
