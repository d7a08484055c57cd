"""Column expressions (all JVM-side built-ins, except one vectorized variant)."""

from ordertide.functions.clean import (  # noqa: F401
    clean_all,
    clean_string,
    epoch_to_timestamp,
    month_key,
    ssn_to_long_in_pandas,
    ssn_format_error,
    ssn_to_long,
    try_cast,
    with_lineage,
)
