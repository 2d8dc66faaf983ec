"""Retail distribution lakehouse on PySpark: Bronze, Silver and Gold as DataFrame functions."""
