"""Column functions over VARIANT documents."""
