from hybrid_sampling.streaming.requests import sample_new_requests  # noqa: F401
