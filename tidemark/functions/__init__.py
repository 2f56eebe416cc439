"""Building blocks as SQL expression text; all JVM-side, no UDFs.

Each function takes SQL expressions (a column name is one) and returns one, to be
used in ``selectExpr`` or ``F.expr``. Text composes in Python for free and reaches
Spark in one call, while a Column costs a call to the JVM per operator: with
hundreds of operators per row that difference is seconds per query.
"""
