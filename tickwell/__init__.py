"""Financial series, filing reports and document retrieval as Spark DataFrame plans."""
