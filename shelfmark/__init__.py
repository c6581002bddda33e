"""Product-catalogue processing for PySpark: landed shop pages in, clean product rows out."""

__version__ = "0.1.0"
