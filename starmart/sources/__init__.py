"""Where frames come from and go to: CSV folders, Parquet, JDBC, staging."""
