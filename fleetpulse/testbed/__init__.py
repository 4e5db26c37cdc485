"""The star-schema test tables seen as a component-health extract, and the queries on them."""
