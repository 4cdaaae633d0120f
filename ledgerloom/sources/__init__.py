"""Where the business tables come from: parquet files, price sheets, or views over the test star schema."""
