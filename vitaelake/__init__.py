"""Scholarly-record ETL as Spark jobs: CV archives and bibliographic pages to silver tables."""
