"""The jobs: cleaning, normalising, star schema, monthly load, reports."""
