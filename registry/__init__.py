"""The library's queries on the supplied tables, and the SQL they are checked against."""
