"""Column functions: codes and keys, geometry, text. All are native Spark expressions."""
