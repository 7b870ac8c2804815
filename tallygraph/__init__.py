"""Business-data analytics on Spark: landed accounting tables, office and XML
files, and captured web pages become typed entities, links and a balanced
double-entry ledger.  Every operator is a DataFrame job."""
