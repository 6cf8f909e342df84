"""Evidence landscape of bibliographic records, as PySpark DataFrame operators."""
