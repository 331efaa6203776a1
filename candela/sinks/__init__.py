from candela.sinks.tables import export, write_table  # noqa: F401
