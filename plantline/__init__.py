"""Supply-chain analytics as Spark DataFrame operators."""
