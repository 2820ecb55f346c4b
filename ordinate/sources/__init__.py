from ordinate.sources.files import file_list, read_files
from ordinate.sources.memory import (
    random_integer_dataset, range_dataset, sparse_slices, tensor_slices_dataset, tensors_dataset,
)
from ordinate.sources.record_spec import RecordSpec, csv_record_spec, delim_record_spec, tsv_record_spec
from ordinate.sources.records import (
    decode_examples, encode_examples, fixed_length_records, framed_records, write_framed_records,
)
from ordinate.sources.sql import sql_dataset, sql_record_spec
from ordinate.sources.text import decode_delim, make_csv_dataset, text_lines
