from hopgraph.functions.scalar import (  # noqa: F401
    cast_bigint, cast_bool, cast_double, cast_text, cast_ts, day_bounds, epoch_seconds_text,
    epoch_seconds_to_ts, json_field, lenient_ts_parse, map_get, micros_to_ts, null_concat,
    split_part, strip_quotes,
)
