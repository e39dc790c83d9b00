"""Relational operators: functions from DataFrame(s) to DataFrame."""
