"""Change-data tables on Spark: event log, current state, history, facts and checks."""
