"""nestmart: a Spark-native batch engine for nested film tables.

Daily raw JSON is cleaned and typed, shaped into one wide ``movies`` table
with arrays of structs plus person, company and calendar dimensions, merged
into the stored tables while each film's in-row ``metrics`` series grows by
one element per day, and reported on by title, genre and cast member.

Layout:

- ``sources``    lake paths, raw/clean readers and writers, tables, schema conforming
- ``functions``  Column-level helpers (casts, array shaping, calendar fields)
- ``operators``  frame-level building blocks (dedupe, collect, merge, top-k, pages)
- ``plans``      composite jobs (clean, model, publish, restructure, calendar, reports)
- ``streaming``  incremental, exactly-once processing of newly landed days
"""

__version__ = "0.1.0"
