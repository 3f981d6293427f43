"""Training-data operators for language-model corpora and splits; nothing outside imports this."""
