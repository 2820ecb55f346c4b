from ordinate.functions.hashing import hash_bucket, seeded_hash, text_hash, uniform
from ordinate.functions.selectors import (
    Selector, all_nominal, all_numeric, contains, ends_with, everything, has_type,
    matches, num_range, one_of, parse_formula, resolve, starts_with,
)
