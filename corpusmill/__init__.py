"""Corpus filtering, text statistics and detector evaluation on PySpark."""
