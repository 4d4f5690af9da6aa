"""DataFrame -> DataFrame operators of the candle pipeline."""
