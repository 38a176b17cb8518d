from kpiwatch.streaming.daily import run_incremental

__all__ = ["run_incremental"]
