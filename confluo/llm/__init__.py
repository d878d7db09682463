"""Operators for preparing training and entity data at scale; nothing outside this package imports it."""
