"""ledgerflow: ERP-to-star-schema analytics as PySpark DataFrame plans."""
