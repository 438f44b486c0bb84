"""Training-data operators: tokenising, packing, storage, deduplication and text classifiers on Spark."""
