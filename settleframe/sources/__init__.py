from settleframe.sources.readers import read_instruments, read_table, read_trades
from settleframe.sources.sinks import register_table, write_table

__all__ = ["read_instruments", "read_table", "read_trades", "register_table", "write_table"]
