"""Operators that prepare training data for language models, each as Spark jobs over whole tables."""
