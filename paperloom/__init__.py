"""Document planning, cleaning and quality analysis as Spark DataFrame programs."""
