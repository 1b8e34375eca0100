"""Scalar Column -> Column functions (§2.9). All native Spark expressions."""
from .hexcodec import (  # noqa: F401
    decimal_to_hex, hex_quality, hex_to_decimal, hex_to_decimal_text, hex_to_long, long_to_hex,
)
from .misc import (  # noqa: F401
    LOG_WIRE_DDL, chunk_label, convert_logs, default_array, empty_array_to_null,
    json_path, logs_quality, pad_block_label, price_krw, price_usd, shard_lane,
    status_flag, strip_leading_zero, strip_tags, strip_text, to_json_text,
)
from .timefmt import (  # noqa: F401
    KST, TEXT_FMT, align_hour, day_key_date, day_keys, epoch_ns_to_ts, epoch_seconds,
    epoch_to_kst, from_epoch_seconds, hex_ts_to_kst, hour_key_ts, kst_hour_keys,
    kst_text, text_to_ts, to_ntz, utc_to_kst,
)
