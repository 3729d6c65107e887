"""Batch operators: functions from DataFrame to DataFrame, shared with the streaming jobs."""
