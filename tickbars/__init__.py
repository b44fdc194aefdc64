"""Market ticks to bars, indicators, gaps and a candle ledger, on Spark."""
