"""Address analytics on Spark: cleaning, extraction, catalogue matching, reports and spatial joins as DataFrame plans."""
