"""Reading and writing: payloads, landed CSV files and warehouse tables."""
