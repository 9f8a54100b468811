"""Tables, control relations and the query catalogue."""
