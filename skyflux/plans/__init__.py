"""Query plans over the driver's test tables: bindings of the survey's logical
tables (``bindings``), their SQL twins (``sql``) and the registered queries."""
