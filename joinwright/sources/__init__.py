from .files import (
    read_table,
    read_tables,
    read_typed,
    save_tables,
    unconverted,
    write_table,
)
from .scratch import cut, made_folders, new_folder, remove_made_folders, shared_folder

__all__ = [
    "cut",
    "made_folders",
    "new_folder",
    "read_table",
    "read_tables",
    "read_typed",
    "remove_made_folders",
    "save_tables",
    "shared_folder",
    "unconverted",
    "write_table",
]
