"""Ledgerloom: analytics over chain-style ledgers, key-value stores and event logs, on PySpark."""
