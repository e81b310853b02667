from sqlweave.sources.tables import read_table, TABLES  # noqa: F401
