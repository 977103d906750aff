"""Operators: functions from DataFrame to DataFrame. The ids (P1, J3, ...) are those of the operator inventory."""
