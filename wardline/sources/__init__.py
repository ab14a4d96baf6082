"""Readers, writers and the catalog tables behind them."""
