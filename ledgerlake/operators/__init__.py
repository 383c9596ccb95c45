"""DataFrame -> DataFrame operators. Each one is a declarative plan fragment;
none collects data to the driver except the explicit validation helpers and
``occurrence_number(skew_safe="auto")``, which each fetch one aggregated row."""
