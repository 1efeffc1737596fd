"""Flows over whole tabs and batches of tabs, and the registered queries."""
