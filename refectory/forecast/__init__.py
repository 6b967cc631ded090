"""Attendance features and forecasts."""
