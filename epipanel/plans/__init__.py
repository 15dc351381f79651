"""Query catalogue, oracle SQL, join-size helpers and the report job."""
