"""Whole plans over the driver's tables, with SQL that gives the same rows."""
