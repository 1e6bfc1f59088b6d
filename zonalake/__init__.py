"""Layered batch analytics on zones and hours, written with the Spark DataFrame API."""
