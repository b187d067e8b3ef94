"""Training-data operators for language-model style corpora."""
