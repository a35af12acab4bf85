"""Word lexicon engine on Spark: collect, count, annotate, maintain and analyse words."""
