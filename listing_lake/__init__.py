"""Listing Lake: a medallion lakehouse for dated listing snapshots on PySpark."""
