"""Analyses and ETL steps: functions from DataFrame to DataFrame, without actions."""
