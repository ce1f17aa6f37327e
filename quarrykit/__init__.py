"""quarrykit: DataFrame operators for curating reference tables and device metrics on Spark."""
