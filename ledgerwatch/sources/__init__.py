"""Reading and writing tables, snapshots, messages and JDBC relations."""
