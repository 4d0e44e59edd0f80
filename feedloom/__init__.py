"""feedloom: change-data-capture analytics expressed as Spark DataFrame plans."""
