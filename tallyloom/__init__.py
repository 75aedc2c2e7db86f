"""tallyloom: subscription-business analytics as PySpark DataFrame operators and data products."""
