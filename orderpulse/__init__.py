"""Order-lifecycle analytics as plain PySpark: functions from DataFrame to DataFrame."""
