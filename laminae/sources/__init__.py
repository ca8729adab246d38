"""Readers: catalog tables, files, JDBC and message logs."""
