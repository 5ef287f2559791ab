"""ledgerline: change-data-capture and market-data analytics written as Spark jobs."""
