"""Reading and writing: files, landing areas, typed records and JDBC."""
