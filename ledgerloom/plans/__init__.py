"""Plans: the composed monthly chain, counters, staging, registered queries."""
