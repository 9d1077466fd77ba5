"""Reading inputs and writing datasets."""

from hearthlake.sources.tables import TableReader
from hearthlake.sources.staging import SourceTables, catalog_sources, stage_sources
from hearthlake.sources.sinks import attach_tables, ensure_schema, save_model, use_schema, write_table

__all__ = ["TableReader", "SourceTables", "catalog_sources", "stage_sources", "attach_tables", "ensure_schema", "save_model", "use_schema",
           "write_table"]
