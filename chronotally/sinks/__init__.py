from chronotally.sinks.parquet import spread_by, write_partitioned, write_table
