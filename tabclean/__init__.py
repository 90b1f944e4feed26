"""tabclean: cleaning and analysis of large tables, expressed as Spark plans."""
