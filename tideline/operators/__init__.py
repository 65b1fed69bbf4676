"""DataFrame -> DataFrame operators (batch; most also accept streaming input)."""
