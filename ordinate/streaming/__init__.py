from ordinate.streaming.keyed import group_by_window_stream, scan_stream, short_windows
from ordinate.streaming.run import per_micro_batch, run_available, snapshot_stream, unique_stream
from ordinate.streaming.stateful import column_state, timed_windows, typed_scan
from ordinate.streaming.totals import reduce_stream, reduced
