"""The warehouse: staging, identity, dimensions, facts, marts and KPIs."""
