"""Inputs and outputs: derived property feed, CSV, JDBC and layer storage."""
