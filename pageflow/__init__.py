"""Page-to-page traffic: ingestion, additive edge totals, word index and search, as Spark plans."""
