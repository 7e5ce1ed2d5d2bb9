"""ledgermill: a bronze / silver / gold event-ledger engine on PySpark DataFrames."""
