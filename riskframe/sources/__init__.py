from riskframe.sources.models import load_model, save_model
from riskframe.sources.replace import recover_table, replace_table
from riskframe.sources.tables import (conform, frame_from_records, read_table, scratch_path, stored,
                                      trim_headers, write_table)

__all__ = ["conform", "frame_from_records", "load_model", "read_table", "recover_table",
           "replace_table", "save_model",
           "scratch_path", "stored", "trim_headers", "write_table"]
