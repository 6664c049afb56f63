"""Registered queries over the driver's tables, with the SQL each must agree with.

The scholarly inputs (CV documents, author and work records, API responses) are derived by
Spark from the whole given tables: customer = researcher, supplier = author, documents and
orders = works.
"""
