from crestline.functions.messages import (
    decode_json,
    encode_value,
    rejected_json,
    with_event_time,
    with_watermark,
)

__all__ = ["decode_json", "encode_value", "rejected_json", "with_event_time", "with_watermark"]
