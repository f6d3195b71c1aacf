"""Tables of scalar and N-dimensional cells on Spark."""

from hypercell.config import config, settings
from hypercell.operators.table import Table, safe_multithreaded_writes, write_table
from hypercell.sources.descriptor import ms_descriptor


def table(filename: str, ninstances: int = 1, readonly: bool = True, lockoptions="auto", **more) -> Table:
    """Open a table; ``path::NAME`` is the subtable NAME. ``ninstances`` and lock options are accepted; with several
    instances a table cannot be written."""
    return Table.from_filename(filename, ninstances, readonly, lockoptions, **more)


__all__ = ["Table", "config", "ms_descriptor", "safe_multithreaded_writes", "settings", "table", "write_table"]
