"""Folder of the driver's smallest tables, read by the tests."""

SMALL_SF = "/root/testdata/sf0.001"
