"""millrace: cleaning, linking, checking and summarising semi-structured records on Spark."""
