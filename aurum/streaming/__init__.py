"""Structured Streaming: micro-batch resolution with versioned state (RT-*)."""
