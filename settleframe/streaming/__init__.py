from settleframe.streaming.bronze_stream import start_trades_stream

__all__ = ["start_trades_stream"]
