"""Training-data pipeline operators: one module per operator, registered queries in ``catalog``."""
