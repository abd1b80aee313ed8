"""Readers: delimited files, SQL and foreign tables, generated inputs."""
