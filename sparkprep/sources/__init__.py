from sparkprep.sources.tables import TABLES, read_table, write_result, register_views

__all__ = ["TABLES", "read_table", "write_result", "register_views"]
