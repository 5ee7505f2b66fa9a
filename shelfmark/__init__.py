"""shelfmark: a catalog-quality and record-linkage engine expressed as Spark DataFrame plans."""
