"""Fleet-expense ledger and reconciliation reports on Spark DataFrames."""
