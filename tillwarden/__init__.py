"""Spark-native payment intelligence: fraud scoring, ledgers, lifecycles, marts and checks."""
