"""Where rows come from: Parquet folders, catalog tables, JDBC databases and their catalogs."""
