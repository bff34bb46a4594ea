"""claimspark: healthcare-claims analytics as Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
small dict of them) and is written against the DataFrame/SQL API so that
Catalyst and AQE plan the physical work.
"""

__version__ = "0.1.0"
