"""tallyfield: a Spark-native engine for checklist observation data."""
