"""Part of lumenspan: functions."""
