"""Staging, marts, views and dashboards: functions from input frames to result frames."""
