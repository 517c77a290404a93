"""tallyloom: behavioural features, record linkage and table preparation on Spark."""
