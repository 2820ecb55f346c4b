from ordinate.operators.aggregation import (
    fold_rows, length, output_shapes, output_types, reduce_rows, rejection_resample, scan, scan_rows, unique,
)
from ordinate.operators.batching import (
    batch, bucket_by_sequence_length, group_by_window, padded_batch, rebatch, summarize_batches, unbatch, window,
)
from ordinate.operators.combine import (
    choose_from_datasets, interleave, sample_from_datasets, shuffle, shuffle_and_repeat,
)
from ordinate.operators.mapping import filter_rows, flat_map, map_and_batch, map_pandas, map_rows, prepare
from ordinate.operators.materialize import cache, collect, single_element, snapshot
from ordinate.operators.position import (
    concatenate, enumerate_rows, repeat, shard, skip, take, take_while, zip_datasets,
)
from ordinate.operators.table_functions import flat_map_table, register_functions, row_function, table_function
