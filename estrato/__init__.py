"""Medallion analytics on Spark: raw lines and payloads in, typed facts out.

Layers are called bronze, silver_trans, silver_ctx and gold.  Operators are
``DataFrame -> DataFrame`` functions, scalar functions are ``Column -> Column``.
"""
