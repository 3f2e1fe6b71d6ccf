"""The recurring jobs, put together from operators."""
