"""Job plans: functions from input DataFrames to output DataFrames."""
