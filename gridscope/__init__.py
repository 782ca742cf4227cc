"""gridscope: cellular measurement analytics as PySpark DataFrame functions."""
