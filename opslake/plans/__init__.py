"""The three domains, their gold tables, the semantic layer and the feeds."""
