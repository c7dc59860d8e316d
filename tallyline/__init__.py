"""Spark operators for the back-end data of metered AI and commerce services."""
