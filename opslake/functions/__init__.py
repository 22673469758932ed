"""Column expressions shared by the batch, streaming and serving plans."""
