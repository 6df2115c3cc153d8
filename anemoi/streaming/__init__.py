from anemoi.streaming.delivery import feed_stream, start_delivery  # noqa: F401
