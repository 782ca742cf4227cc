"""Reading and writing: partitioned tables, delimited text, JDBC, exports."""
