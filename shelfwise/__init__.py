"""shelfwise: retail analytics and data-quality operators on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame; nothing is
collected to the driver.  Sub-packages:

* ``sources``   - declared schemas, table loading, literal rows, layers
* ``functions`` - column expressions and the business metric rules
* ``operators`` - joins, aggregates, windows, set ops, quality, reports
* ``plans``     - plan evidence and data layout helpers
* ``streaming`` - (nothing: the reference has no streaming work)
* ``catalog``   - the registered queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
