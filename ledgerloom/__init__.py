"""ledgerloom: Spark-native marts over ledgers, users, events and text."""
