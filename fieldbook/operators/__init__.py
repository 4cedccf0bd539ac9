"""Operators: functions from DataFrame to DataFrame, all lazy unless their docstring says otherwise."""
