"""Query plans over the driver's tables: fixtures, end-to-end flows, the query
catalog and its SQL oracle."""
