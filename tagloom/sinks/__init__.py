"""Writers for messages, CSV files, JDBC tables and the console."""
